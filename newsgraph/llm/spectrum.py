"""Leading eigenpairs of a symmetric matrix by slicing its spectrum.

An LDLᵀ factorisation of the shifted matrix has as many positive pivots as there are eigenvalues above the shift. Counts
at bisected shifts isolate each leading eigenvalue, Rayleigh quotient iteration converges to it from there, and two more
counts certify that it has the number it was looked for by.
"""

from __future__ import annotations

import math

import numpy as np

_ALPHA = (1 + math.sqrt(17)) / 8
# Relative to the norm: intervals are not halved below this; eigenvalues so close together share an eigenspace.
NARROW = 1e-11
# Relative to the norm: how far above and below an eigenvalue the counts that certify its number are taken.
CERTIFY = 1e-9


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of `matrix` above `shift`: positive pivots of LDLᵀ with pivots of one or two rows."""
    m = matrix - shift * np.eye(len(matrix))
    size, k, positive = len(m), 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            m[[i, j]] = m[[j, i]]
            m[:, [i, j]] = m[:, [j, i]]

    while k < size:
        below = np.abs(m[k + 1 :, k])
        most = below.max() if len(below) else 0.0
        single = True
        if most and abs(m[k, k]) < _ALPHA * most:
            r = k + 1 + int(below.argmax())
            other = np.abs(m[k:, r])
            other[r - k] = 0
            if abs(m[k, k]) * other.max() < _ALPHA * most * most:
                if abs(m[r, r]) >= _ALPHA * other.max():
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    single = False
        if single:
            pivot = m[k, k]
            positive += pivot > 0
            if pivot:
                column = m[k + 1 :, k].copy()
                m[k + 1 :, k + 1 :] -= np.outer(column, column / pivot)
            k += 1
        else:
            block, columns = m[k : k + 2, k : k + 2].copy(), m[k + 2 :, k : k + 2].copy()
            determinant = block[0, 0] * block[1, 1] - block[0, 1] ** 2
            positive += 1 if determinant < 0 else 2 * (block[0, 0] > 0)
            m[k + 2 :, k + 2 :] -= columns @ np.linalg.solve(block, columns.T)
            k += 2
    return int(positive)


def _solved(matrix: np.ndarray, shift: float, vector: np.ndarray, norm: float) -> np.ndarray:
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        out = np.linalg.solve(shifted, vector)
        if np.isfinite(out).all():
            return out
    except np.linalg.LinAlgError:
        pass
    return np.linalg.solve(shifted + norm * 1e-15 * np.eye(len(matrix)), vector)


def _pair(matrix: np.ndarray, low: float, high: float, found: np.ndarray, norm: float, seed: int) -> tuple[float, np.ndarray]:
    """The eigenpair in (low, high) that is orthogonal to the rows of `found`."""

    def tidy(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - found.T @ (found @ v)
        return v / np.linalg.norm(v)

    vector = tidy(np.random.default_rng(seed).standard_normal(len(matrix)))
    middle = (low + high) / 2
    for _ in range(4):
        vector = tidy(_solved(matrix, middle, vector, norm))
    value, best = float(vector @ matrix @ vector), math.inf
    for _ in range(30):
        left = float(np.linalg.norm(matrix @ vector - value * vector))
        if left >= best * 0.5 and left <= 1e-12 * norm or left == 0:
            break
        best = min(best, left)
        shift = value if low <= value <= high else middle
        vector = tidy(_solved(matrix, shift, vector, norm))
        value = float(vector @ matrix @ vector)
    return value, vector


def leading(matrix: np.ndarray, most: int, least: float = 1e-12) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as rows): at most `most`, those above `least` times the trace.

    `matrix` is symmetric and positive semidefinite. Equal eigenvalues get any orthonormal basis of their space. A number
    that the counts do not confirm raises an ArithmeticError.
    """
    size, trace = len(matrix), float(np.trace(matrix))
    if not size or not trace > 0:
        return np.empty(0), np.empty((0, size))
    norm = float(np.linalg.norm(matrix))
    floor = least * trace
    wanted = min(most, count_above(matrix, floor))
    counts: dict[float, int] = {floor: count_above(matrix, floor), norm * 1.01: 0}

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = count_above(matrix, shift)
        return counts[shift]

    values, vectors = [], np.empty((0, size))
    for k in range(1, wanted + 1):
        low = max(s for s, n in counts.items() if n >= k)
        high = min(s for s, n in counts.items() if n < k)
        # until the eigenvalue is alone in an interval that is small beside its distance from zero, or in a cluster
        while high - low > NARROW * norm and (counts[low] != k or counts[high] != k - 1 or high - low > 0.05 * high):
            middle = (low + high) / 2
            low, high = (middle, high) if count(middle) >= k else (low, middle)
        while True:
            value, vector = _pair(matrix, low, high, vectors, norm, k)
            inside = low - CERTIFY * norm <= value <= high + CERTIFY * norm
            if inside and count(value + CERTIFY * norm) < k <= count(value - CERTIFY * norm):
                break
            if high - low <= NARROW * norm:
                raise ArithmeticError(f"eigenvalue {k} is not certified")
            middle = (low + high) / 2
            low, high = (middle, high) if count(middle) >= k else (low, middle)
        values.append(value)
        vectors = np.vstack([vectors, vector])
    return np.array(values), vectors
