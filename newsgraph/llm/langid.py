"""Language identification by interpolated Kneser-Ney character models, one per language.

Runs of four characters are counted over all training rows, map-side first. Continuation counts, context totals and
discounts are groupings of that table in Spark. A model that fits is broadcast whole, as sorted hash arrays. Of a larger
one the most frequent runs are, with their probabilities worked out; all others that texts have are asked for block by
block, and answered by joins with the whole tables. Both ways give the same result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.llm.asks import BLOCK_BYTES, BLOCK_KEYS, asked_type, block_number, frequent, with_answers
from newsgraph.llm.batches import slices
from newsgraph.llm.charcodes import Counters, HashArray, folded, has_letter
from newsgraph.operators.scale import broadcast_if_small, small_enough
from newsgraph.scratch import materialise

ORDER = 4
# (language, run) rows of each order up to which the model is broadcast whole, and numbers that the broadcast part of a
# larger one holds: runs times languages.
MODEL_GRAMS, NEAR_NUMBERS = 1_000_000, 16_000_000
# Characters whose evidence counts towards the score; beyond them it is certain anyway.
SCORE_CHARS = 60
# A text is marked as rejected if its cross-entropy is so many deviations above what its language's texts have.
REJECT_DEVIATIONS = 4.0
UNKNOWN = "und"


def held_out(key: str = "doc_id", fold: int = 2, folds: int = 4) -> Column:
    """Whether a row is kept out of learning; a null key never is."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _keys(codes: np.ndarray) -> np.ndarray:
    """The runs of ORDER codes that end at each character after the edges, 16 bits a code."""
    wide = codes.astype(np.uint64)
    size = len(codes) - ORDER + 1
    keys = wide[:size].copy()
    for k in range(1, ORDER):
        keys = (keys << np.uint64(16)) | wide[k : k + size]
    return keys


def gram_counts(rows: DataFrame, text: str, classes: str) -> DataFrame:
    """`classes`, gram (64 bits), n: how often each run of four characters occurs in the texts of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = Counters()

        def out() -> Iterator[pa.RecordBatch]:
            for name, keys, numbers in counters.empty():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(numbers)], names=[classes, "gram", "n"])

        for batch in batches:
            for part in slices(batch, text):
                parts: dict[str, list[np.ndarray]] = {}
                for name, value in zip(part.column(part.schema.get_field_index(classes)).to_pylist(),
                                       part.column(part.schema.get_field_index(text)).to_pylist(), strict=True):
                    parts.setdefault(name, []).append(_keys(folded(value, ORDER - 1)))
                for name, keys in parts.items():
                    if counters.add(name, np.concatenate(keys)):
                        yield from out()
        yield from out()

    partial = rows.select(classes, text).mapInArrow(run, f"{classes} string, gram long, n long")
    return partial.groupBy(classes, "gram").agg(F.sum("n").alias("n"))


def order_tables(grams: DataFrame, classes: str) -> dict[int, DataFrame]:
    """By order: class, gram, n, total. Below the highest order n counts distinct left neighbours (continuations)."""
    tables, at = {}, grams
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            mask = (1 << (16 * order)) - 1
            at = at.groupBy(classes, F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        context = F.shiftrightunsigned("gram", 16) if order > 1 else F.lit(0)
        tables[order] = at.withColumn("total", F.sum("n").over(Window.partitionBy(classes, context)))
    return tables


@dataclass
class Model:
    """Names of the classes; by order the grams with their log-probabilities, the contexts with their backoff weights."""

    names: list[str]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    contexts: dict[int, tuple[np.ndarray, np.ndarray]]
    floor: np.ndarray


@dataclass
class FarModel:
    """A model that is too large to broadcast whole: log-probabilities of the most frequent runs, and tables of the rest.

    `values[k]` has (key, p) of all runs of k characters, an entry of p for each language; `left[k]` has (key, w) of their
    contexts: what they leave to the order below.
    """

    names: list[str]
    keys: np.ndarray
    logs: np.ndarray
    values: dict[int, DataFrame]
    left: dict[int, DataFrame]


def _discounts(table: DataFrame, classes: str) -> dict[str, float]:
    few = table.groupBy(classes).agg(F.sum((F.col("n") == 1).cast("long")).alias("one"), F.sum((F.col("n") == 2).cast("long")).alias("two"))
    found = {r[classes]: r["one"] / (r["one"] + 2 * r["two"]) if r["two"] else 0.5 for r in few.collect()}  # a row for each class
    return {name: min(max(d, 0.05), 0.95) for name, d in found.items()}


def far_model(tables: dict[int, DataFrame], classes: str, numbers: int = NEAR_NUMBERS) -> FarModel:
    """The model of `order_tables`, by joins. Rows of one run meet in a grouping: one for each language at most."""
    discounts = {order: _discounts(table, classes) for order, table in tables.items()}
    names = sorted(discounts[1])
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(classes)).cast("int")
    every = F.sequence(F.lit(0), F.lit(len(names) - 1))

    def spread(column: str, otherwise: float) -> Column:
        by_place = F.map_from_entries(F.collect_list(F.struct(place - 1, F.col(column))))
        return F.transform(every, lambda i: F.coalesce(F.try_element_at(by_place, i), F.lit(otherwise)))

    values, left = {}, {}
    for order in range(1, ORDER + 1):
        table = tables[order]
        taken = F.element_at(F.create_map(*[F.lit(x) for name in names for x in (name, discounts[order].get(name, 0.5))]), F.col(classes))
        context = F.shiftrightunsigned("gram", 16) if order > 1 else F.lit(0).cast("long")
        rows = table.withColumn("own", (F.col("n") - taken) / F.col("total")).withColumn("context", context)
        mass = rows.groupBy("context", classes).agg(F.least(F.lit(1.0), F.greatest(F.lit(1e-9), 1 - F.sum("own"))).alias("w"))
        left[order] = materialise(mass.groupBy(F.col("context").alias("key")).agg(spread("w", 1.0).alias("w")), f"left-{order}")
        own = rows.groupBy("gram", "context").agg(spread("own", 0.0).alias("own"), F.sum("n").alias("n"))
        joined = own.join(left[order].select(F.col("key").alias("context"), "w"), "context")
        if order == 1:
            lower = joined.withColumn("lower", F.array_repeat(F.lit(1.0 / 0x10000), len(names)))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << (16 * (order - 1))) - 1)).alias("suffix")
            below = values[order - 1].select(F.col("key").alias("suffix"), F.col("p").alias("lower"))
            lower = joined.select("gram", "n", "own", "w", suffix).join(below, "suffix")
        p = F.zip_with("own", F.zip_with("w", "lower", lambda w, low: w * low), lambda mine, rest: mine + rest)
        values[order] = materialise(lower.select(F.col("gram").alias("key"), "n", p.alias("p")), f"values-{order}")
    near = frequent(values[ORDER], numbers // max(1, len(names))).select("key", "p").toArrow()
    logs = np.log(near.column("p").combine_chunks().flatten().to_numpy(zero_copy_only=False)).astype(np.float32).reshape(-1, len(names))
    return FarModel(names, near.column("key").to_numpy().view(np.uint64), logs, {k: v.select("key", "p") for k, v in values.items()}, left)


def far_logs(model: FarModel, keys: DataFrame) -> DataFrame:
    """key, values: log-probabilities in every language of the last character of each run in `keys` (key, distinct)."""
    found = keys.withColumn("p", F.array_repeat(F.lit(1.0 / 0x10000), len(model.names)))
    for order in range(1, ORDER + 1):
        gram = F.col("key") if order == ORDER else F.col("key").bitwiseAND(F.lit((1 << (16 * order)) - 1))
        context = F.shiftrightunsigned(gram, 16) if order > 1 else F.lit(0).cast("long")
        own = model.values[order].select(F.col("key").alias("_gram"), F.col("p").alias("_own"))
        rest = model.left[order].select(F.col("key").alias("_context"), F.col("w").alias("_w"))
        found = found.withColumns({"_gram": gram, "_context": context}).join(broadcast_if_small(own), "_gram", "left").join(broadcast_if_small(rest), "_context", "left")
        less = F.when(F.col("_w").isNull(), F.col("p")).otherwise(F.zip_with("_w", "p", lambda w, p: w * p))
        found = found.select("key", F.coalesce("_own", less).alias("p"))
    return found.select("key", F.transform("p", lambda x: F.log(x)).alias("values"))


def train(rows: DataFrame, text: str, classes: str, most: int = MODEL_GRAMS, numbers: int = NEAR_NUMBERS) -> Model | FarModel:
    """Interpolated Kneser-Ney models of all classes in `rows` (no nulls in either column)."""
    tables = order_tables(materialise(gram_counts(rows, text, classes), "gram-counts"), classes)
    tables = {order: materialise(table, f"grams-{order}") for order, table in tables.items()}
    if any(not small_enough(table, most) for table in tables.values()):
        return far_model(tables, classes, numbers)
    frames = {order: table.toArrow().to_pandas() for order, table in tables.items()}
    discounts = {order: _discounts(table, classes) for order, table in tables.items()}
    names = sorted(discounts[1])
    place = {name: i for i, name in enumerate(names)}
    grams, contexts, below = {}, {}, None
    floor = np.full(len(names), 1.0 / 0x10000)
    for order in range(1, ORDER + 1):
        frame = frames[order]
        column = frame[classes].map(place).to_numpy(dtype=np.int64) if len(frame) else np.empty(0, dtype=np.int64)
        keys, row = np.unique(frame["gram"].to_numpy(dtype=np.int64).view(np.uint64), return_inverse=True)
        taken = np.array([discounts[order].get(name, 0.5) for name in names])[column] if len(frame) else column
        share = (frame["n"].to_numpy(dtype=float) - taken) / frame["total"].to_numpy(dtype=float) if len(frame) else np.empty(0)
        own = np.zeros((len(keys), len(names)))
        own[row, column] = share
        above = keys >> np.uint64(16) if order > 1 else np.zeros_like(keys)
        context_keys, context_row = np.unique(above, return_inverse=True)
        mass = np.zeros((len(context_keys), len(names)))
        np.add.at(mass, context_row, own)
        weights = np.clip(1.0 - mass, 1e-9, 1.0)
        # probability of the lower order for each gram: the gram without its first code
        if below is None:
            lower = np.broadcast_to(floor, own.shape)
        else:
            lower = _probabilities(below, keys & np.uint64((1 << (16 * (order - 1))) - 1), order - 1, floor)
        grams[order] = (keys, own + weights[context_row] * lower)
        contexts[order] = (context_keys, weights)
        below = Model(names, grams, contexts, floor)
    return Model(
        names, {k: (key, np.log(p).astype(np.float32)) for k, (key, p) in grams.items()},
        {k: (key, np.log(w).astype(np.float32)) for k, (key, w) in contexts.items()}, np.log(floor).astype(np.float32),
    )


def _probabilities(model: Model, keys: np.ndarray, order: int, floor: np.ndarray) -> np.ndarray:
    """Interpolated probabilities of grams of an order while the model is being built (not logarithms yet)."""
    if not order:
        return np.broadcast_to(floor, (len(keys), len(floor))).copy()
    known, values = model.grams[order]
    row = HashArray(known).rows(keys)
    out = np.empty((len(keys), len(floor)))
    out[row >= 0] = values[row[row >= 0]]
    missing = np.flatnonzero(row < 0)
    if len(missing):
        rest = keys[missing]
        context, weights = model.contexts[order]
        at = HashArray(context).rows(rest >> np.uint64(16) if order > 1 else np.zeros_like(rest))
        factor = np.where((at >= 0)[:, None], weights[np.maximum(at, 0)] if len(weights) else 1.0, 1.0)
        out[missing] = factor * _probabilities(model, rest & np.uint64((1 << (16 * (order - 1))) - 1), order - 1, floor)
    return out


class Scorer:
    """A model with its hash arrays, in a worker."""

    def __init__(self, model: Model):
        self.model = model
        self.grams = {k: HashArray(keys) for k, (keys, _) in model.grams.items()}
        self.contexts = {k: HashArray(keys) for k, (keys, _) in model.contexts.items()}

    def logs(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log-probability in every class of the last code of each gram, given those before."""
        if not order:
            return np.broadcast_to(self.model.floor, (len(keys), len(self.model.floor))).copy()
        row = self.grams[order].rows(keys)
        values = self.model.grams[order][1]
        out = values[np.maximum(row, 0)] if len(values) else np.empty((len(keys), len(self.model.names)), dtype=np.float32)
        missing = np.flatnonzero(row < 0)
        if len(missing):
            rest = keys[missing]
            at = self.contexts[order].rows(rest >> np.uint64(16) if order > 1 else np.zeros_like(rest))
            weights = self.model.contexts[order][1]
            back = np.where((at >= 0)[:, None], weights[np.maximum(at, 0)], np.float32(0)) if len(weights) else np.float32(0)
            out[missing] = back + self.logs(rest & np.uint64((1 << (16 * (order - 1))) - 1), order - 1)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character of each text in every class, characters)."""
        keys = [_keys(folded(t, ORDER - 1)) for t in texts]
        sizes = np.array([len(k) for k in keys], dtype=np.int64)
        sums = np.zeros((len(texts), len(self.model.names)))
        if not texts:
            return sums, sizes
        every, begins = np.concatenate(keys), np.cumsum(sizes) - sizes
        step = max(10_000, 2_000_000 // max(1, len(self.model.names)))
        for at in range(0, len(every), step):
            logs = self.logs(every[at : at + step])
            first = int(np.searchsorted(begins, at, side="right")) - 1
            last = int(np.searchsorted(begins, at + len(logs), side="left"))
            sums[first:last] += np.add.reduceat(logs, np.maximum(begins[first:last] - at, 0), axis=0, dtype=np.float64)
        return -sums / sizes[:, None], sizes


_scorers: dict[str, Scorer | HashArray] = {}


def _scorer(shared, made):
    """What `made` makes of a broadcast value, kept in the worker under the name drawn for it."""
    name, value = shared.value
    if name not in _scorers:
        _scorers.clear()
        _scorers[name] = made(value)
    return _scorers[name]


def _asked(docs: DataFrame, model: FarModel, key: str, text: str) -> DataFrame:
    """Rows of `asked_type`: key, sums of the logs that are here, number of characters (null where there is no letter)."""
    shared = docs.sparkSession.sparkContext.broadcast((os.urandom(16).hex(), (model.keys, model.logs)))
    width = len(model.names)
    row_type = T.StructType([
        T.StructField("key", docs.schema[key].dataType), T.StructField("sums", T.ArrayType(T.DoubleType())), T.StructField("size", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, block, seen, like = TaskContext.get().partitionId(), 0, 0, None
        asked = np.empty(0, dtype=np.uint64)
        waiting: list[tuple[pa.Array, list, list, list[np.ndarray]]] = []

        def close() -> Iterator[pa.RecordBatch]:
            number = block_number(partition, block)
            for names, sums, sizes, missing in waiting:
                rows = pa.StructArray.from_arrays([names, pa.array(sums, pa.list_(pa.float64())), pa.array(sizes, pa.int64())], names=["key", "sums", "size"])
                asks = [np.searchsorted(asked, m).astype("<i4").tobytes() for m in missing]
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(sizes), pa.int64()), rows, pa.array(asks, pa.binary()), pa.nulls(len(sizes), pa.list_(pa.int64()))], names=["block", "row", "asks", "keys"])
            if len(asked):
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.nulls(1, like), pa.nulls(1, pa.binary()), pa.array([asked.view(np.int64)], pa.list_(pa.int64()))], names=["block", "row", "asks", "keys"])

        for batch in batches:
            for part in slices(batch, text):
                array, logs = _scorer(shared, lambda value: (HashArray(value[0]), value[1]))
                sums, sizes, missing = [], [], []
                for value in part.column(1).to_pylist():
                    grams = _keys(folded(value, ORDER - 1)) if value and has_letter(value) else np.empty(0, dtype=np.uint64)
                    rows = array.rows(grams)
                    here = rows[rows >= 0]
                    sums.append(logs[here].sum(axis=0, dtype=np.float64) if len(here) else np.zeros(width))
                    sizes.append(len(grams) or None)
                    missing.append(grams[rows < 0])
                    seen += len(value or "")
                names = part.column(0)
                like = pa.struct([("key", names.type), ("sums", pa.list_(pa.float64())), ("size", pa.int64())])
                asked = np.union1d(asked, np.concatenate(missing))
                waiting.append((names, sums, sizes, missing))
                if len(asked) >= BLOCK_KEYS or seen >= BLOCK_BYTES // 4:  # the block's rows wait for its last key
                    yield from close()
                    asked, waiting, block, seen = np.empty(0, dtype=np.uint64), [], block + 1, 0
        yield from close()

    return docs.select(key, text).mapInArrow(run, asked_type(row_type, T.LongType()))


def _identify_far(docs: DataFrame, model: FarModel, key: str, text: str) -> DataFrame:
    asked = materialise(_asked(docs, model, key, text), "language-asked")
    keys = asked.where(F.col("keys").isNotNull()).select(F.explode("keys").alias("key")).distinct()
    found = with_answers(asked, far_logs(model, keys), len(model.names))
    size = F.col("row.size")
    entropies = F.transform(F.zip_with("row.sums", "sums", lambda a, b: a + b), lambda x: -x / size)
    judged = found.where(size.isNotNull()).select(F.col("row.key").alias(key), size.alias("_size"), entropies.alias("_e"))
    low = F.array_min("_e")
    odds = F.aggregate("_e", F.lit(0.0), lambda s, e: s + F.exp(-(e - low) * F.least(F.col("_size"), F.lit(SCORE_CHARS))))
    name = F.element_at(F.array(*[F.lit(n) for n in model.names]), F.array_position("_e", low).cast("int"))
    judged = judged.select(key, name.alias("lang_pred"), (1 / odds).alias("score"), low.alias("entropy"))
    rest = found.where(size.isNull()).select(F.col("row.key").alias(key), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"))
    return judged.unionByName(rest)


def identify(docs: DataFrame, model: Model | FarModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score, entropy of every row, by whole texts.

    The language of least cross-entropy per character wins, ties go to the name that sorts first. `score` is its share of
    the likelihoods of all languages, with at most 60 characters' worth of evidence. Null texts, texts without a letter,
    and all texts under a model without languages are `und` with score 0 and a null entropy. Rows are independent.
    """
    if isinstance(model, FarModel):
        return _identify_far(docs, model, key, text)
    shared = docs.sparkSession.sparkContext.broadcast((os.urandom(16).hex(), model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                scorer = _scorer(shared, Scorer)
                values = part.column(1).to_pylist()
                ready = [i for i, v in enumerate(values) if v and scorer.model.names and has_letter(v)]
                names, scores, found = [UNKNOWN] * len(values), np.zeros(len(values)), [None] * len(values)
                entropies, sizes = scorer.entropies([values[i] for i in ready])
                if ready:
                    best = entropies.argmin(axis=1)
                    low = entropies[np.arange(len(ready)), best]
                    odds = np.exp(-(entropies - low[:, None]) * np.minimum(sizes, SCORE_CHARS)[:, None])
                    scores[ready] = 1 / odds.sum(axis=1)
                    for i, b, e in zip(ready, best, low, strict=True):
                        names[i], found[i] = scorer.model.names[b], float(e)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(found, pa.float64())],
                    names=[key, "lang_pred", "score", "entropy"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double, entropy double")


def languages(docs: DataFrame, most: int = MODEL_GRAMS, numbers: int = NEAR_NUMBERS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy, rejected of every document.

    Models learn from rows that are not held out and have text, language and id. `rejected` marks texts whose entropy is
    far above that of the training texts of the language they got; the prediction stands beside it.
    """
    learn = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    model = train(learn.select(F.col("lang").cast("string").alias("lang"), "text"), "text", "lang", most, numbers)
    found = materialise(identify(docs, model), "languages")
    usual = (
        found.where(F.col("doc_id").isNotNull() & ~held_out() & F.col("entropy").isNotNull())
        .groupBy(F.col("lang_pred").alias("name"))
        .agg(F.avg("entropy").alias("mean"), F.coalesce(F.stddev("entropy"), F.lit(0.0)).alias("deviation"))
        .collect()
    )  # one row per language
    limit = F.lit(None).cast("double")
    for r in usual:
        limit = F.when(F.col("lang_pred") == r["name"], F.lit(r["mean"] + REJECT_DEVIATIONS * r["deviation"])).otherwise(limit)
    rejected = F.coalesce(F.col("entropy") > limit, F.lit(True))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "entropy", rejected.alias("rejected"))
