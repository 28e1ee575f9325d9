"""Toxicity by class-conditional Kneser-Ney models of runs of characters.

Toxic and ordinary texts have a model each: discounted counts of their own runs of five characters, interpolated with
lower orders whose continuation counts come from both classes together, so an expression that is too rare to tell apart
gets nearly the same likelihood from both. The tables are groupings and joins in Spark. The length-normalised difference
of the two log-likelihoods, of the whole text and of its most toxic passages of some lengths, goes into a logistic curve,
fitted by Spark on rows that a second pair of models has not seen.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.llm.asks import BLOCK_BYTES, BLOCK_KEYS, block_number, frequent
from newsgraph.llm.batches import slices
from newsgraph.llm.charcodes import Counters, HashArray, folded
from newsgraph.llm.langid import held_out
from newsgraph.operators.scale import broadcast_if_small
from newsgraph.scratch import materialise

ORDER, BITS = 5, 10
_CODES = 1 << BITS
# Letters up to here have a code of their own, all others share what is left.
_PLAIN = 592
# Runs and contexts that are broadcast: 8 bytes a key, 4 a value. All others are asked for; none is left out.
NEAR_GRAMS = 2_000_000
# Occurrences that a context borrows from the lower orders, besides what the discounts leave.
STRENGTH = 3.0
# Characters of the passages that are compared, besides the whole text.
PASSAGES = (8, 20, 60, 200, 600)
# Differences of passages enter the curve as logarithms, raised by this much; below zero they count as zero.
FLOOR = 0.02
FEATURES = 3 + len(PASSAGES)
# The curve where there is nothing to fit it to, and how strongly it is drawn there.
PRIOR = np.array([-2.0, 0.5] + [0.0] * (FEATURES - 2))
PULL = np.array([0.01] + [0.3] * (FEATURES - 1))
THRESHOLD = 0.3
# The fold of the learning rows that fits the curve.
CURVE_FOLD = 3


def _keys(text: str) -> np.ndarray:
    """The runs of ORDER codes that end at each character, BITS bits a code."""
    codes = folded(text, ORDER - 1).astype(np.uint64)
    codes = np.where(codes < _PLAIN, codes, _PLAIN + (codes * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(_CODES - _PLAIN))
    size = len(codes) - ORDER + 1
    keys = codes[:size].copy()
    for k in range(1, ORDER):
        keys = (keys << np.uint64(BITS)) | codes[k : k + size]
    return keys


def gram_counts(rows: DataFrame) -> DataFrame:
    """gram, t, o, ct, co: occurrences in toxic and ordinary texts, and the part of them from rows that fit the curve.

    `rows` has text (no nulls), toxic (0 or 1) and for_curve. Counts combine in the task, then by the grouping.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = Counters()

        def out() -> Iterator[pa.RecordBatch]:
            for kind, keys, numbers in counters.empty():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(np.full(len(keys), kind, dtype=np.int32)), pa.array(numbers)], names=["gram", "kind", "n"]
                )

        for batch in batches:
            for part in slices(batch, "text"):
                parts: dict[int, list[np.ndarray]] = {}
                for text, toxic, curve in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True):
                    parts.setdefault(2 * int(toxic) + int(curve), []).append(_keys(text))
                for kind, keys in parts.items():
                    if counters.add(kind, np.concatenate(keys)):
                        yield from out()
        yield from out()

    partial = rows.select("text", "toxic", "for_curve").mapInArrow(run, "gram long, kind int, n long")
    of = lambda *kinds: F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), F.col("n"))), F.lit(0))
    return partial.groupBy("gram").agg(of(2, 3).alias("t"), of(0, 1).alias("o"), of(3).alias("ct"), of(1).alias("co"))


def _discount(one: int | None, two: int | None) -> float:
    return min(max(one / (one + 2 * two) if one and two else 0.5, 0.05), 0.95)


def _seen(n: str) -> list:
    return [F.sum((F.col(n) == k).cast("long")).alias(f"{n}{k}") for k in (1, 2)]


def shared_orders(grams: DataFrame) -> DataFrame:
    """gram, q of all runs one shorter than those of `grams`: Kneser-Ney by continuation counts of both classes."""
    tables, at = {}, grams.select("gram")
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << BITS * order) - 1))
        at = tables[order] = materialise(at.groupBy(suffix.alias("gram")).agg(F.count(F.lit(1)).alias("n")), f"order-{order}")
    below = None
    for order in range(1, ORDER):
        table = tables[order]
        few = table.agg(*_seen("n")).first()
        discount = _discount(few["n1"], few["n2"])
        context = Window.partitionBy(F.shiftright("gram", BITS))  # one code follows a context: _CODES rows at most
        total, kinds = F.sum("n").over(context), F.count(F.lit(1)).over(context)
        table = table.withColumns({"own": (F.col("n") - discount) / total, "rest": discount * kinds / total})
        if below is None:
            lower = table.withColumn("lower", F.lit(1.0 / _CODES))
        else:
            lower = table.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1))).join(
                below.select(F.col("gram").alias("suffix"), F.col("q").alias("lower")), "suffix"
            )
        below = lower.select("gram", (F.col("own") + F.col("rest") * F.col("lower")).alias("q"))
    return below


def log_ratios(grams: DataFrame) -> DataFrame:
    """key, value, n: ln P(last code | context, toxic) - ln P(same | ordinary) of all runs that `grams` (gram, t, o) has.

    Runs that it does not have get the same probability from the lower orders, so only what their context leaves to these
    counts: that is a row under the complement of the context. Without a context it is 0.
    """
    few = grams.agg(*_seen("t"), *_seen("o")).first()
    context = Window.partitionBy("context")
    columns, left = {}, {}
    for kind in "to":
        discount = _discount(few[f"{kind}1"], few[f"{kind}2"])
        total, kinds = F.sum(kind).over(context) + F.lit(STRENGTH), F.sum((F.col(kind) > 0).cast("long")).over(context)
        left[kind] = (discount * kinds + F.lit(STRENGTH)) / total
        columns[kind] = F.greatest(F.col(kind) - F.lit(discount), F.lit(0.0)) / total
    at = grams.withColumn("context", F.shiftright("gram", BITS)).withColumns({
        "own_t": columns["t"], "own_o": columns["o"], "left_t": left["t"], "left_o": left["o"], "held": F.sum(F.col("t") + F.col("o")).over(context),
    })
    at = materialise(at, "contexts")
    shared = shared_orders(grams).select(F.col("gram").alias("suffix"), "q")
    whole = at.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << BITS * (ORDER - 1)) - 1))).join(shared, "suffix")
    p = lambda kind: F.log(F.col(f"own_{kind}") + F.col(f"left_{kind}") * F.col("q"))
    runs = whole.select(F.col("gram").alias("key"), (p("t") - p("o")).cast("float").alias("value"), (F.col("t") + F.col("o")).alias("n"))
    contexts = at.groupBy(F.bitwise_not("context").alias("key")).agg(
        F.first(F.log("left_t") - F.log("left_o")).cast("float").alias("value"), F.first("held").alias("n")
    )
    return materialise(runs.unionByName(contexts), "ratios")


@dataclass
class Model:
    """Differences of the most frequent runs and contexts, here, and of all of them in `whole` if that is more."""

    keys: np.ndarray
    values: np.ndarray
    whole: DataFrame | None = None


def train(grams: DataFrame, most: int = NEAR_GRAMS) -> Model:
    """The model of `grams` (gram, t, o); without rows of both classes it knows nothing."""
    sums = grams.agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    if not sums["t"] or not sums["o"]:
        return Model(np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.float32))
    ratios = log_ratios(grams)
    whole = ratios.limit(most + 1).count() > most
    near = (frequent(ratios, most) if whole else ratios).select("key", "value").toArrow()  # `most` rows at most
    keys, values = near.column("key").to_numpy().view(np.uint64), near.column("value").to_numpy()
    return Model(keys, values, ratios.select("key", "value") if whole else None)


class Scorer:
    """A model in a worker."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.array, self.values = HashArray(keys), values

    def known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(differences, whether there is one) of keys."""
        rows = np.concatenate([self.array.rows(keys[i : i + 1_000_000]) for i in range(0, len(keys), 1_000_000)]) if len(keys) else np.empty(0, dtype=np.int32)
        out = np.zeros(len(keys), dtype=np.float32)
        out[rows >= 0] = self.values[rows[rows >= 0]]
        return out, rows >= 0

    def differences(self, keys: np.ndarray) -> np.ndarray:
        """Difference at every run: its own, else that of its context, else none."""
        out, found = self.known(keys)
        rest = np.flatnonzero(~found)
        out[rest] = self.known(~(keys[rest] >> np.uint64(BITS)))[0]
        return out

    def asks(self, keys: np.ndarray) -> np.ndarray:
        """Distinct keys that are not here: of runs, and of the contexts of those."""
        rest = np.unique(keys)
        rest = rest[~self.known(rest)[1]]
        contexts = np.unique(~(rest >> np.uint64(BITS)))
        return np.concatenate([rest, contexts[~self.known(contexts)[1]]])


def features(differences: np.ndarray) -> list[float]:
    """What the curve takes of a text: one, ten times the mean, passages by length, and the text's length."""
    size = len(differences)
    sums = np.concatenate([[0.0], np.cumsum(differences, dtype=np.float64)])
    most = [float((sums[w:] - sums[:-w]).max()) / w if size > w else sums[-1] / max(1, size) for w in PASSAGES]
    return [1.0, 10 * sums[-1] / max(1, size), *[math.log(FLOOR + max(0.0, m)) for m in most], math.log(max(1, size))]


_scorers: dict[str, Scorer] = {}


def evidence(rows: DataFrame, model: Model, key: str, text: str = "text") -> DataFrame:
    """key and `x` (the features) of every row; a null text counts as empty.

    Where the whole model is broadcast that is a projection. Else texts are written with the keys that each block of them
    lacks, and the answers of a block meet its texts in one task.
    """
    name = os.urandom(16).hex()
    shared = rows.sparkSession.sparkContext.broadcast((name, model.keys, model.values))
    kind = rows.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def scorer() -> Scorer:
        if shared.value[0] not in _scorers:
            _scorers.clear()
            _scorers[shared.value[0]] = Scorer(*shared.value[1:])
        return _scorers[shared.value[0]]

    def judged(names: pa.Array, texts: list[str | None], more: Scorer | None) -> pa.RecordBatch:
        found = []
        for value in texts:
            keys = _keys(value or "")
            out, here = scorer().known(keys)
            rest = np.flatnonzero(~here)
            if len(rest):
                answers, answered = more.known(keys[rest]) if more else (np.zeros(len(rest), dtype=np.float32), np.zeros(len(rest), dtype=bool))
                left = np.flatnonzero(~answered)
                contexts = ~(keys[rest[left]] >> np.uint64(BITS))
                values, near = scorer().known(contexts)
                far = np.flatnonzero(~near)
                if more and len(far):
                    values[far] = more.known(contexts[far])[0]
                answers[left] = values
                out[rest] = answers
            found.append(features(out if len(keys) > 1 else 0 * out))  # a text without letters has no evidence
        return pa.RecordBatch.from_arrays([names, pa.array(found, pa.list_(pa.float64()))], names=[key, "x"])

    def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield judged(part.column(0), part.column(1).to_pylist(), None)

    rows = rows.select(key, text)
    if model.whole is None:
        return rows.mapInArrow(direct, schema)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, block, seen = TaskContext.get().partitionId(), 0, 0
        asked = np.empty(0, dtype=np.uint64)

        def pack(part: pa.RecordBatch, keys: np.ndarray | None) -> pa.RecordBatch:
            n = part.num_rows
            lists = pa.nulls(n, pa.list_(pa.int64())) if keys is None else pa.array([keys.view(np.int64)], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([block_number(partition, block)] * n, pa.int64()), *part.columns, lists], names=["block", "name", "text", "keys"])

        def closing(like: pa.RecordBatch) -> pa.RecordBatch:
            return pack(pa.RecordBatch.from_arrays([pa.nulls(1, c.type) for c in like.columns], names=like.schema.names), asked)

        part = None
        for batch in batches:
            for part in slices(batch, text):
                texts = [t or "" for t in part.column(1).to_pylist()]
                asked = np.union1d(asked, scorer().asks(np.concatenate([_keys(t) for t in texts])))
                yield pack(part, None)
                seen += sum(map(len, texts))
                if len(asked) >= BLOCK_KEYS or seen >= BLOCK_BYTES:
                    yield closing(part)
                    asked, block, seen = np.empty(0, dtype=np.uint64), block + 1, 0
        if len(asked):
            yield closing(part)

    written = T.StructType([T.StructField("block", T.LongType()), T.StructField("name", kind), T.StructField("text", T.StringType()), T.StructField("keys", T.ArrayType(T.LongType()))])
    asked = materialise(rows.mapInArrow(ask, written), "toxic-asked")
    wanted = asked.where(F.col("keys").isNotNull()).select("block", F.explode("keys").alias("key"))
    nothing = lambda what, name: F.lit(None).cast(what).alias(name)
    answers = wanted.join(model.whole, "key").select("block", F.lit(0).alias("kind"), "key", "value", nothing(kind, "name"), nothing("string", "text"))
    texts = asked.where(F.col("keys").isNull()).select("block", F.lit(1).alias("kind"), nothing("long", "key"), nothing("float", "value"), "name", "text")
    together = answers.unionByName(texts).repartition("block").sortWithinPartitions("block", "kind")

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, more = None, [], None
        for batch in batches:
            blocks, kinds = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if begin == end:
                    continue
                if blocks[begin] != at:
                    at, held, more = blocks[begin], [], None
                piece = batch.slice(begin, end - begin)
                if not kinds[begin]:
                    held.append((piece.column(2).to_numpy(zero_copy_only=False), piece.column(3).to_numpy(zero_copy_only=False)))
                    continue
                if more is None:
                    keys = np.concatenate([h[0] for h in held]).astype(np.int64).view(np.uint64) if held else np.empty(0, dtype=np.uint64)
                    more = Scorer(keys, np.concatenate([h[1] for h in held]).astype(np.float32) if held else np.empty(0, dtype=np.float32))
                for part in slices(piece, "text"):
                    yield judged(part.column(4), part.column(5).to_pylist(), more)

    return together.mapInArrow(answered, schema)


def curve(rows: DataFrame) -> np.ndarray:
    """Weights of the logistic curve through `rows` (x, toxic), by Newton's steps; each is one sum over all rows."""
    weights = PRIOR.copy()
    at = [F.col("x")[i] for i in range(FEATURES)]
    pairs = [(i, j) for i in range(FEATURES) for j in range(i, FEATURES)]
    for _ in range(12):
        z = sum((F.lit(float(w)) * x for w, x in zip(weights, at, strict=True)), F.lit(0.0))
        with_p = rows.withColumn("p", 1 / (1 + F.exp(-z)))
        sums = with_p.agg(
            *[F.coalesce(F.sum((F.col("p") - F.col("toxic")) * x), F.lit(0.0)).alias(f"g{i}") for i, x in enumerate(at)],
            *[F.coalesce(F.sum(F.col("p") * (1 - F.col("p")) * at[i] * at[j]), F.lit(0.0)).alias(f"h{i}_{j}") for i, j in pairs],
        ).first()
        slope = np.array([sums[f"g{i}"] for i in range(FEATURES)]) + PULL * (weights - PRIOR)
        bend = np.diag(PULL)
        for i, j in pairs:
            bend[i, j] += sums[f"h{i}_{j}"]
            bend[j, i] = bend[i, j]
        step = np.linalg.solve(bend, slope)
        step *= min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        weights = weights - step
        if np.abs(step).max() < 1e-4:
            break
    return weights


def scores(docs: DataFrame, labels: DataFrame, most: int = NEAR_GRAMS) -> DataFrame:
    """doc_id, held_out, difference, score, predicted of every document.

    Labels of held-out documents are not read. Labels are broadcast up to a checked size, beyond it joined by a shuffle.
    `difference` is the length-normalised toxic log-likelihood less the ordinary one. Null and empty texts and texts without
    letters have none; without labelled texts of both classes no text has any. A document with several labels is learnt once for each,
    repeated rows are repeated, texts may be of any length, other columns are not looked at, scores equal to the threshold
    are predicted toxic, and an empty table gives no rows.
    """
    kept_out, ids = held_out(), F.col("doc_id").isNotNull()
    known = labels.where(F.col("toxic").isin(0, 1) & ids & ~kept_out).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    learn = docs.where(ids & ~kept_out & F.col("text").isNotNull()).select("doc_id", "text").join(broadcast_if_small(known), "doc_id")
    learn = learn.withColumn("for_curve", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == CURVE_FOLD)
    counts = materialise(gram_counts(learn), "toxic-grams")
    part = train(counts.select("gram", (F.col("t") - F.col("ct")).alias("t"), (F.col("o") - F.col("co")).alias("o")).where("t + o > 0"), most)
    unseen = evidence(learn.where("for_curve").select(F.struct("doc_id", "toxic").alias("row"), "text"), part, key="row")
    weights = curve(materialise(unseen.select("x", F.col("row.toxic").alias("toxic")), "toxic-curve"))
    judged = evidence(docs, train(counts.select("gram", "t", "o"), most), key="doc_id")
    z = sum((F.lit(float(w)) * F.col("x")[i] for i, w in enumerate(weights)), F.lit(0.0))
    return judged.withColumn("score", 1 / (1 + F.exp(-z))).select(
        "doc_id", kept_out.alias("held_out"), (F.col("x")[1] / 10).alias("difference"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
