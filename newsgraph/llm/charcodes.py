"""Text as folded character codes, and sorted hash arrays to look up what is known about runs of them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

SPACE, EDGE = 0x20, 0x01
# Letters of the ideographic planes share one code; they arrive as the first halves of surrogate pairs.
FAR_LETTER = 0xFFFF


@lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """Code of every 16-bit unit: the lower-case letter, or a space if it is no letter."""
    out = np.full(0x10000, SPACE, dtype=np.uint16)
    for code in range(0x10000):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            out[code] = ord(lower) if len(lower) == 1 and ord(lower) < FAR_LETTER else code
    out[0xD840:0xD8C0] = FAR_LETTER
    return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def folded(text: str, edges: int) -> np.ndarray:
    """Codes of a text: lower-case letters, one space for any run of others, `edges` edge codes before, a space after."""
    codes = _fold()[np.frombuffer(text.encode("utf-16-le", "surrogatepass"), dtype="<u2")]
    blank = codes == SPACE
    codes = codes[~(blank & np.concatenate([[True], blank[:-1]]))] if len(codes) else codes
    closing = [SPACE] if not len(codes) or codes[-1] != SPACE else []
    return np.concatenate([np.full(edges, EDGE, dtype=np.uint16), codes, np.array(closing, dtype=np.uint16)])


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


# Distinct keys and their numbers that a counter holds before it merges them, and before they have to be handed on.
MERGE_KEYS, FULL_KEYS = 1_500_000, 750_000


class Counters:
    """Numbers of 64-bit keys by kind, in bounded memory: whoever counts empties them whenever they are full."""

    def __init__(self) -> None:
        self.held: dict[object, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, kind: object, keys: np.ndarray) -> bool:
        """Count `keys`; true if the counters should be emptied now."""
        pair = np.unique(keys, return_counts=True)
        self.held.setdefault(kind, []).append(pair)
        self.size += len(pair[0])
        if self.size > MERGE_KEYS:
            for name in self.held:
                self.held[name] = [self._merged(name)]
            self.size = sum(len(pairs[0][0]) for pairs in self.held.values())
        return self.size > FULL_KEYS and all(len(pairs) == 1 for pairs in self.held.values())

    def _merged(self, kind: object) -> tuple[np.ndarray, np.ndarray]:
        pairs = self.held[kind]
        if len(pairs) == 1:
            return pairs[0]
        keys, numbers = np.concatenate([k for k, _ in pairs]), np.concatenate([n for _, n in pairs])
        order = np.argsort(keys)
        keys, numbers = keys[order], numbers[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
        return keys[first], np.add.reduceat(numbers, first) if len(first) else numbers

    def empty(self) -> Iterator[tuple[object, np.ndarray, np.ndarray]]:
        """Kind, keys (signed) and numbers of all that was counted; nothing is held afterwards."""
        for kind in list(self.held):
            keys, numbers = self._merged(kind)
            del self.held[kind]
            yield kind, keys.view(np.int64), numbers.astype(np.int64)
        self.size = 0


class HashArray:
    """Row numbers of 64-bit keys, by a sorted array of hashes and the place where each hash prefix begins."""

    def __init__(self, keys: np.ndarray):
        hashes = mixed(keys.astype(np.uint64))
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.bits = max(1, min(22, int(len(keys)).bit_length() + 1))
        prefixes = (self.hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        self.begin = np.searchsorted(prefixes, np.arange((1 << self.bits) + 1)).astype(np.int32)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key in the array it was built from; -1 if it is not there."""
        out = np.full(len(keys), -1, dtype=np.int32)
        if not len(self.hashes) or not len(keys):
            return out
        hashes = mixed(keys)
        prefix = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        place, stop = self.begin[prefix], self.begin[prefix + 1]
        left = np.flatnonzero(place < stop)
        while len(left):
            here = place[left]
            found = self.hashes[here]
            wanted = hashes[left]
            hit = found == wanted
            out[left[hit]] = self.order[here[hit]]
            place[left] += 1
            left = left[(found < wanted) & (here + 1 < stop[left])]
        return out
