"""SimHash near-duplicates: fingerprints of word shingles, linked by a generalised pigeonhole search.

The 64 bits are dealt into partitions, bits that go together into the same one. If the partitions' thresholds add up to
the maximum distance less the number of partitions plus one, every pair in reach agrees within its threshold in at least
one partition. The thresholds may differ, and -1 skips a partition; dynamic programming picks those that cost least by
estimated candidates. The choice decides about speed alone: every probe is verified on all bits, and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.llm.batches import fresh_name, map_texts
from newsgraph.llm.components import components
from newsgraph.scratch import materialise

BITS = 64
# Fixed by the contract.
HASH_SEED = 42
# The costs of thresholds are estimated on so many fingerprints; the search itself covers all.
SAMPLE_ROWS = 2_000
# A bucket with more fingerprints than this is searched by shared neighbours, which needs no pairs.
BUCKET_ROWS = 200
# A probe is a row to shuffle, a candidate a comparison.
PROBE_COST = 20.0


def fingerprint(text: str, words: int = 3) -> int:
    """SimHash of the lower-cased shingles of `words` words: a bit is set if it is in over half of the hashes."""
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), HASH_SEED)
    counts, total = np.zeros(BITS, dtype=np.int64), len(tokens) - words + 1
    digest, joined = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, total, 65_536):  # a very long text goes by in parts
        stop = min(start + 65_536, total)
        grams = zip(*[tokens[start + k : stop + k] for k in range(words)], strict=True)
        hashes = np.fromiter([digest(joined(g), HASH_SEED) for g in grams], dtype="<u8", count=stop - start)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", output: str = "fp") -> DataFrame:
    """Add `output`: the fingerprint of the whole text as a signed long. Null and wordless texts get zero."""

    def apply(texts: list) -> list[np.ndarray]:
        return [np.array([fingerprint(t or "", words) for t in texts], dtype="<u8").view("<i8")]

    return map_texts(docs, text, [(output, T.LongType(), pa.int64())], apply)


@dataclass(frozen=True)
class Plan:
    """Partitions of the bits and the threshold of each; -1 leaves a partition out."""

    partitions: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]


def correlated_partitions(bits: np.ndarray, count: int) -> tuple[tuple[int, ...], ...]:
    """`count` partitions of equal size; each takes the free bits that go most with those it has already."""
    spread = bits.std(axis=0)
    centred = (bits - bits.mean(axis=0)) / np.where(spread > 0, spread, 1)
    together = np.abs(centred.T @ centred) / max(1, len(bits))
    np.fill_diagonal(together, 0)
    free, out = list(range(BITS)), []
    sizes = [BITS // count + (i < BITS % count) for i in range(count)]
    for size in sizes:
        chosen = [max(free, key=lambda b: (together[b, free].max(), -b))]
        free.remove(chosen[0])
        while len(chosen) < size:
            nearest = max(free, key=lambda b: (together[b, chosen].sum(), -b))
            chosen.append(nearest)
            free.remove(nearest)
        out.append(tuple(sorted(chosen)))
    return tuple(out)


def _ball(size: int, threshold: int) -> int:
    """Values within `threshold` bits of a value of `size` bits."""
    total = term = 1
    for k in range(1, threshold + 1):
        term = term * (size - k + 1) // k
        total += term
    return total


def _independent(means: np.ndarray) -> np.ndarray:
    """Chances that two fingerprints differ in 0, 1, 2, ... of some bits, if the bits were independent."""
    chances = np.array([1.0])
    for differ in 2 * means * (1 - means):
        chances = np.convolve(chances, [1 - differ, differ])
    return chances


def allocate(costs: Sequence[Sequence[float]], budget: int) -> tuple[float, tuple[int, ...]]:
    """Thresholds of least total cost that add up to `budget`; costs[i][t + 1] is that of threshold t, from -1 on."""
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for options in costs:
        reached: dict[int, tuple[float, tuple[int, ...]]] = {}
        for used, (cost, chosen) in best.items():
            for t, extra in enumerate(options, start=-1):
                entry = (cost + extra, (*chosen, t))
                if used + t not in reached or entry < reached[used + t]:
                    reached[used + t] = entry
        best = reached
    return best.get(budget, (float("inf"), ()))


def plan_search(sample: np.ndarray, total: int, distance: int) -> Plan:
    """The cheapest of several numbers of partitions, each with its best thresholds, for `total` fingerprints.

    `sample` (unsigned 64-bit) tells how often two fingerprints agree within a threshold on a partition.
    """
    bits = np.unpackbits(np.ascontiguousarray(sample, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    if not len(bits):
        bits = np.zeros((1, BITS))
    best: tuple[float, Plan] | None = None
    for count in range(1, min(8, distance + 3) + 1):
        partitions, costs = correlated_partitions(bits, count), []
        whole = bits.sum(axis=1)
        apart_in_all = whole[:, None] + whole[None, :] - 2 * bits @ bits.T
        for chosen in partitions:
            part = bits[:, list(chosen)]
            norms = part.sum(axis=1)
            apart = norms[:, None] + norms[None, :] - 2 * part @ part.T
            pairs = max(1, len(bits) * (len(bits) - 1))
            options, expected = [0.0], _independent(part.mean(axis=0))
            for t in range(0, min(distance, 2) + 1):
                # below what the sample can show, bits count as independent, so that no partition ever looks free
                share = max(((apart <= t + 0.5) & (apart_in_all > distance + 0.5)).sum() / pairs, expected[: t + 1].sum())
                options.append(PROBE_COST * total * _ball(len(chosen), t) + share * float(total) * total / 2)
            costs.append(options)
        cost, thresholds = allocate(costs, distance - count + 1)
        if thresholds and (best is None or cost < best[0]):
            best = (cost, Plan(partitions, thresholds))
    assert best is not None
    return best[1]


def _mask(bits: Sequence[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def _probes(fp: Column, plan: Plan) -> Column:
    """Array of (part, value, own): the values that a fingerprint stands for or looks up in each partition.

    A pair that agrees within t on a partition meets at the smaller fingerprint's own value, which the other one reaches
    by flipping up to t bits.
    """
    probes = []
    for number, (bits, threshold) in enumerate(zip(plan.partitions, plan.thresholds, strict=True)):
        if threshold < 0:
            continue
        value = fp.bitwiseAND(F.lit(_mask(bits)))
        for flips in range(threshold + 1):
            for flipped in combinations(bits, flips):
                probes.append(F.struct(
                    F.lit(number).alias("part"), value.bitwiseXOR(F.lit(_mask(flipped))).alias("value"), F.lit(flips == 0).alias("own")
                ))
    return F.array(*probes)


def near_links(fps: DataFrame, distance: int = 2, bucket_rows: int = BUCKET_ROWS, plan: Plan | None = None) -> DataFrame:
    """Links a < b between distinct fingerprints (column `fp`) whose bits differ in at most `distance` places.

    Buckets of up to `bucket_rows` fingerprints are joined and verified pair by pair. Those of fuller buckets meet where
    they share a neighbour, at half the distance, and are tied to the least one there: each of those links is within the
    distance, and every pair in reach is connected by them, though not each by a link of its own. So components are
    exact, and neither way grows with the square of a bucket.
    """
    total = fps.count()
    if plan is None:
        sample = [r["fp"] for r in fps.orderBy(F.xxhash64("fp")).limit(SAMPLE_ROWS).collect()]
        plan = plan_search(np.array(sample, dtype="<i8").view("<u8"), total, distance)
    probes = fps.select("fp", F.explode(_probes(F.col("fp"), plan)).alias("p")).select("fp", "p.part", "p.value", "p.own")
    full = probes.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows).drop("n")
    full = materialise(full, "full-buckets")
    key = ["part", "value"]
    calm = probes.join(full, key, "left_anti")
    a = calm.where("own").select(*key, F.col("fp").alias("a"))
    b = calm.select(*key, F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    links = a.join(b, key).where((F.col("a") != F.col("b")) & near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    crowded = probes.join(full, key, "left_semi").select("fp").distinct()
    return materialise(links.unionByName(_through_neighbours(crowded, distance)).distinct(), "near-links")


def _through_neighbours(fps: DataFrame, distance: int) -> DataFrame:
    """Links by shared neighbours: (distance / 2) flips away from both ends lies a value that both can name."""
    half, odd = divmod(distance, 2)
    flips = [0, *[_mask(c) for k in range(1, half + 1) for c in combinations(range(BITS), k)]]
    reach = fps.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f)) for f in flips])).alias("value"))
    if odd:  # one more flip on one side only: name the pair of values on either side of it by its smaller end
        reach = reach.select(
            "fp", F.explode(F.array(*[F.struct(F.lit(b).alias("bit"), F.col("value").bitwiseAND(F.lit(~_mask([b]))).alias("value")) for b in range(BITS)])).alias("x")
        ).select("fp", F.col("x.bit").alias("bit"), F.col("x.value").alias("value"))
        keys = ["bit", "value"]
    else:
        keys = ["value"]
    lowest = reach.groupBy(*keys).agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return reach.join(lowest, keys).where("a <> fp").select("a", F.col("fp").alias("b")).distinct()


def groups(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fp (signed long), component_id (smallest doc_id reachable by links, itself included) of every row.

    Equal fingerprints count as one in the search, so copies cost a row each and are never paired. Rows with a null
    doc_id are members but name no component (it is null if they are alone); repeated rows get repeated results; null,
    empty and wordless texts share fingerprint zero and are linked like any other; an empty table gives no rows.
    """
    marked = materialise(fingerprints(docs.select("doc_id", "text"), words).select("doc_id", "fp"), "fingerprints")
    classes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    found = components(near_links(classes.select("fp"), distance), "a", "b", "fp", "root")
    rooted = classes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, kept (the document that stands for its group)."""
    return groups(docs, words, distance).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def one_of_each_group(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its group, with their columns as they are.

    Rows without an id always stay. Of rows that share an id which is kept, all stay.
    """
    own = fresh_name(docs, "_id")
    found = groups(docs, words, distance)
    dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col(own), "left_anti")
