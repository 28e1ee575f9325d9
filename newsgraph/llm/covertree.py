"""Near-duplicate vectors by a cover tree and a dual traversal.

Unit vectors are compared by distance, which grows as the cosine falls. The upper levels of the tree are nested nets with
halving radii over a bounded sample; every vector then goes to its nearest leaf, and the covering radii are taken over
all vectors, so they are exact. The traversal starts at the pair (root, root), splits the wider node of a pair and drops
a pair whose centres are farther apart than both radii and the threshold. Vectors of the leaf pairs that are left meet in
tasks of bounded size, except those that a leaf's radius already rules out. Equal vectors travel as one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.llm.components import components
from newsgraph.scratch import materialise

THRESHOLD = 0.9
# The net is drawn from so many vectors; it decides how well pairs are pruned, not which are found.
SAMPLE_ROWS = 4_096
# Vectors a leaf should have on average, leaves at most, and vectors of one side of a task at most.
LEAF_ROWS, MAX_LEAVES, BLOCK_ROWS = 2_048, 1_024, 4_096
# Single-precision products decide unless they are this close to the threshold; then doubles do.
BAND = 1e-5
SLACK = 1e-5


@dataclass
class Node:
    """A ball around the centre of leaf number `leaf` that covers all vectors of the leaves below it."""

    leaf: int
    level: int
    radius: float = 0.0
    children: list[Node] = field(default_factory=list)


def greedy_net(vectors: np.ndarray, size: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are each farthest from those before, and those distances, until `size` rows or distance `least`."""
    chosen, reach = [0], [2.0]
    far = np.sqrt(np.maximum(0, 2 - 2 * vectors @ vectors[0]))
    while len(chosen) < min(size, len(vectors)):
        row = int(far.argmax())
        if far[row] <= least:
            break
        chosen.append(row)
        reach.append(float(far[row]))
        far = np.minimum(far, np.sqrt(np.maximum(0, 2 - 2 * vectors @ vectors[row])))
    return np.array(chosen), np.array(reach)


def build_tree(centres: np.ndarray, reach: np.ndarray, leaf_radius: np.ndarray) -> Node:
    """Nested levels over the leaves: level k holds the centres whose reach is above 2^(1-k); radii from below."""
    root = Node(0, 0)
    members, level = {0: root}, 0
    while len(members) < len(centres):
        level += 1
        now = np.flatnonzero(reach > 2.0 ** (1 - level))
        if level > 60:
            now = np.arange(len(centres))
        held = np.array(sorted(members))
        nearest = held[(centres[now] @ centres[held].T).argmax(axis=1)]
        grown = {}
        for leaf, parent in zip(now.tolist(), nearest.tolist(), strict=True):
            node = Node(leaf, level)
            members[leaf if leaf in members else parent].children.append(node)  # a centre is its own nearest
            grown[leaf] = node
        members = grown

    def cover(node: Node) -> list[int]:
        leaves = [x for child in node.children for x in cover(child)] or [node.leaf]
        apart = np.sqrt(np.maximum(0, 2 - 2 * centres[leaves] @ centres[node.leaf]))
        node.radius = float((apart + leaf_radius[leaves]).max()) + SLACK
        return leaves

    cover(root)
    return root


def near_leaves(root: Node, centres: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Leaf pairs (a <= b) whose balls come within `reach`, by dual traversal."""
    found, open_pairs = set(), [(root, root)]
    while open_pairs:
        a, b = open_pairs.pop()
        if a is not b:
            apart = math.sqrt(max(0.0, 2 - 2 * float(centres[a.leaf] @ centres[b.leaf])))
            if apart > a.radius + b.radius + reach + SLACK:
                continue
        if not a.children and not b.children:
            found.add((min(a.leaf, b.leaf), max(a.leaf, b.leaf)))
        elif a is b:
            open_pairs += [(x, y) for i, x in enumerate(a.children) for y in a.children[i:]]
        elif a.children and (not b.children or a.radius >= b.radius):
            open_pairs += [(x, b) for x in a.children]
        else:
            open_pairs += [(a, y) for y in b.children]
    return sorted(found)


def _unit(column: pa.Array, size: int) -> np.ndarray:
    """Unit vectors in double precision."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), size)
    scaled = flat / np.abs(flat).max(axis=1, keepdims=True) if len(flat) else flat  # so that squares neither over- nor underflow
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _assigned(vectors: DataFrame, size: int, centres: np.ndarray) -> DataFrame:
    """Add leaf (the nearest centre) and its distance."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _unit(batch.column(batch.schema.get_field_index("embedding")), size) @ shared.value.T
            leaf = near.argmax(axis=1)
            apart = np.sqrt(np.maximum(0, 2 - 2 * near[np.arange(len(leaf)), leaf])) if len(leaf) else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf, pa.int32()), pa.array(apart, pa.float64())], names=[*batch.schema.names, "leaf", "apart"]
            )

    return vectors.mapInArrow(run, T.StructType([*vectors.schema.fields, T.StructField("leaf", T.IntegerType()), T.StructField("apart", T.DoubleType())]))


def _sent(vectors: DataFrame, size: int, centres: np.ndarray, radius: np.ndarray, blocks: np.ndarray, pairs: list[tuple[int, int]], reach: float) -> DataFrame:
    """task, side, node, copies, embedding: every vector once for each task in which it may have a partner.

    A task is a pair of blocks of two leaves that may be near; a vector is not sent where it is farther from the other
    leaf's centre than that leaf's radius and the threshold.
    """
    partners: list[list[int]] = [[] for _ in centres]
    for a, b in pairs:
        partners[a].append(b)
        if a != b:
            partners[b].append(a)
    shared = vectors.sparkSession.sparkContext.broadcast((centres, radius + reach + SLACK, blocks, [np.array(p, dtype=np.int64) for p in partners]))
    offsets = np.cumsum(blocks) - blocks
    every = int(blocks.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, within, held, near = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                names = part.schema.names
                nodes = part.column(names.index("node")).to_numpy()
                leaves = part.column(names.index("leaf")).to_numpy()
                apart = np.sqrt(np.maximum(0, 2 - 2 * _unit(part.column(names.index("embedding")), size) @ at.T))
                rows, tasks, sides = [], [], []
                for row, (node, leaf) in enumerate(zip(nodes.tolist(), leaves.tolist(), strict=True)):
                    own = int(offsets[leaf]) + node % int(held[leaf])
                    for other in near[leaf][apart[row, near[leaf]] <= within[near[leaf]]].tolist():
                        for block in range(int(offsets[other]), int(offsets[other]) + int(held[other])):
                            rows.append(row)
                            tasks.append(min(own, block) * every + max(own, block))
                            sides.append(own > block)
                taken = part.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tasks, pa.int64()), pa.array(sides, pa.bool_()), *[taken.column(names.index(c)) for c in ("node", "copies", "embedding")]],
                    names=["task", "side", "node", "copies", "embedding"],
                )

    fields = [T.StructField("task", T.LongType()), T.StructField("side", T.BooleanType()), *[vectors.schema[c] for c in ("node", "copies", "embedding")]]
    return vectors.mapInArrow(run, T.StructType(fields))


def _joined(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels after tying `left` and `right` together: every group keeps the least label."""
    pairs = np.unique(np.stack([labels[left], labels[right]], axis=1), axis=0)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    if not len(pairs):
        return labels
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    for a, b in pairs.tolist():
        a, b = top(a), top(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    table = np.arange(len(labels))
    for x in parent:
        table[x] = top(x)
    return table[labels]


def _compared(sent: DataFrame, size: int, every: int, threshold: float) -> DataFrame:
    """node, links, root of the vectors that have a partner in a task: how many (copies counted), and the least node that
    links of the task reach."""

    def run(table: pa.Table) -> pa.Table:
        task = table.column("task")[0].as_py()
        side = table.column("side").to_numpy()
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        order = np.argsort(nodes, kind="stable")
        side, nodes, copies = side[order], nodes[order], copies[order]
        exact = _unit(table.column("embedding").combine_chunks(), size)[order]
        single = exact.astype(np.float32)
        alone = task // every == task % every
        first = np.arange(len(nodes)) if alone else np.flatnonzero(~side)
        second = first if alone else np.flatnonzero(side)
        labels, links = np.arange(len(nodes)), np.zeros(len(nodes))
        for at in range(0, len(first), 512):
            rows = first[at : at + 512]
            product = single[rows] @ single[second].T
            r, c = np.nonzero(product >= threshold - BAND)
            left, right = rows[r], second[c]
            if alone:
                once = left < right
                r, c, left, right = r[once], c[once], left[once], right[once]
            sure = product[r, c] >= threshold + BAND
            doubt = np.flatnonzero(~sure)
            if len(doubt):
                sure[doubt] = np.einsum("ij,ij->i", exact[left[doubt]], exact[right[doubt]]) >= threshold
            left, right = left[sure], right[sure]
            links += np.bincount(left, copies[right], len(nodes)) + np.bincount(right, copies[left], len(nodes))
            labels = _joined(labels, left, right)
        linked = np.flatnonzero(links > 0)
        return pa.table({"node": nodes[linked], "links": links[linked].astype(np.int64), "root": nodes[labels[linked]]})

    return sent.groupBy("task").applyInArrow(run, "node long, links long, root long")


def _linked(vectors: DataFrame, size: int, threshold: float) -> DataFrame:
    """node, links, root of distinct vectors of one length, by tree; `vectors` has node, copies, embedding."""
    total = vectors.count()
    reach = math.sqrt(2 - 2 * threshold)
    sample = vectors.select("embedding").orderBy(F.xxhash64("embedding")).limit(SAMPLE_ROWS).toArrow()
    drawn = _unit(sample.column("embedding").combine_chunks(), size)
    rows, far = greedy_net(drawn, max(1, min(MAX_LEAVES, math.ceil(total / LEAF_ROWS))), reach / 2)
    centres = drawn[rows]
    placed = materialise(_assigned(vectors, size, centres), "leaves")
    radius, held = np.zeros(len(centres)), np.ones(len(centres), dtype=np.int64)
    for r in placed.groupBy("leaf").agg(F.max("apart").alias("radius"), F.count(F.lit(1)).alias("n")).collect():  # a row per leaf
        radius[r["leaf"]], held[r["leaf"]] = r["radius"], r["n"]
    blocks = -(-held // BLOCK_ROWS)
    pairs = near_leaves(build_tree(centres, far, radius), centres, reach)
    sent = _sent(placed, size, centres, radius, blocks, pairs, reach)
    return _compared(sent, size, int(blocks.sum()), threshold)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of `vectors` (vec_id, embedding).

    Two vectors are linked if their cosine in double precision is at least `threshold` (above 0); n_links counts other
    rows, equal vectors included; component_id is the smallest vec_id that links reach. Vectors that are null or empty,
    have null or non-finite components or only zeros link with nothing, nor do vectors of different lengths with each
    other. Rows without a vec_id link with nothing and count for nobody; their component is null. Rows that share a vec_id
    are vectors of their own. Labels and other columns are not looked at. An empty table gives no rows.
    """
    usable = F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
    usable &= F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(usable & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", F.when(usable, F.col("embedding")).alias("embedding"))
    distinct = (
        rows.where(F.col("embedding").isNotNull())
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    )
    classes = materialise(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    sizes = sorted(r["n"] for r in classes.select(F.size("embedding").alias("n")).distinct().collect())
    found = None
    for size in sizes:
        part = _linked(classes.where(F.size("embedding") == size), size, threshold)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = classes.sparkSession.createDataFrame([], "node long, links long, root long")
    found = materialise(found, "vector-links")
    groups = components(found, "node", "root", "node", "root")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.join(counts, "node", "left").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = known.groupBy("root").agg(F.min("first").alias("component_id"))
    whole = known.join(named, "root").select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    return rows.join(whole, "embedding", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )
