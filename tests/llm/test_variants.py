"""Spelling variants against all pairs compared one by one."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from newsgraph.llm import variants


def distance_is_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    table = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, table[0] = table[0], i
        for j, y in enumerate(b, 1):
            last, table[j] = table[j], min(table[j] + 1, table[j - 1] + 1, last + (x != y))
    return table[-1] == 1


def brute_near(words):
    out = {}
    for w, n in words.items():
        near = [x for x in words if distance_is_one(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 2 * n else None
        out[w] = (n, len(near), form, words[form] if form else None)
    return out


def vocabulary(count, seed, letters="abcdeé"):
    rnd = random.Random(seed)
    words = {}
    while len(words) < count:
        words["".join(rnd.choice(letters) for _ in range(rnd.randrange(5, 8)))] = rnd.choice([3, 3, 4, 7, 7, 20, 900])
    return words


@pytest.mark.parametrize("limits", [(20_000, 200_000), (30, 25)])
def test_near_words(spark, limits):
    words = vocabulary(400, 5) | {"abcd" * 30: 4, "abcd" * 29 + "abce": 9, "abcd" * 30 + "x": 8, "zzzzz": 3}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    found = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"]) for r in variants.near_words(frame, *limits).collect()}
    assert found == brute_near(words)


def test_large_leaf_by_deletions(monkeypatch):
    words = list(vocabulary(150, 8, "abc"))
    numbers, counts = np.arange(len(words)), np.ones(len(words), dtype=np.int64)
    entries = variants.Entries(numbers, words, counts, np.zeros(256, dtype=np.int64))
    pairs = lambda: sorted((words[q], entries.words[w]) for q, w in zip(*entries.near(words, numbers), strict=True))
    usual = pairs()
    monkeypatch.setattr(variants, "LARGE_LEAF", 10)
    assert pairs() == usual and len({frozenset(p) for p in usual}) == len(usual)
    assert {frozenset(p) for p in usual} == {frozenset((a, b)) for a in words for b in words if distance_is_one(a, b)}


def test_one_edit():
    words = [*vocabulary(60, 3, "ab"), "", "a", "b", "ab"]
    assert all(variants.one_edit(a, b) == distance_is_one(a, b) for a in words for b in words)


def test_damage():
    rnd = random.Random(1)
    seen = 0
    for i in range(3000):
        word = "".join(rnd.choice("abcÿ") for _ in range(rnd.randrange(1, 9)))
        h = zlib.crc32(f"{i}:{word}".encode())
        wanted = word if h % 97 else word[: h % len(word)] + word[h % len(word) + 1 :]
        seen += wanted != word
        assert variants.damaged(word, zlib.crc32(f"{i}:".encode())) == wanted
    assert seen > 10


def brute(rows):
    import re
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            counts[variants.damaged(run, zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))] += 1
    near = brute_near({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    out = []
    for w, (n, links, form, form_n) in near.items():
        root = w
        while near[root][2]:
            root = near[root][2]
        out.append((w, form, root, n, links, form_n))
    return sorted(out, key=repr)


def test_documents(spark, messy, empty):
    found = lambda df: sorted(map(tuple, variants.spelling_variants(df).collect()), key=repr)
    assert found(messy) == brute([(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()])
    assert found(empty) == []
    chain = [(i, t) for i, t in enumerate(["aaaaaa " * 3, "aaaaab " * 6, "aaaabb " * 12, "AAABBB " * 30 + "ÀÉÎÕÜ÷× " * 3, "x" * 200_000])]
    rows = chain * 1 + [(None, None), (7, ""), (8, "Éaaaa éaaaa Éaaaa")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame) == brute(rows)
    assert ("aaaaaa", "aaaaab", "aaabbb", 3, 1, 6) in found(frame)
