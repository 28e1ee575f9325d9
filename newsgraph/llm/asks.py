"""Look up what a worker's own table does not hold, without shuffling texts.

A task that scores texts numbers the keys it does not know, block by block, and writes for each row the numbers of its
unknown keys, and for each block the keys themselves. The keys are joined with the full table, and the answers of a
block meet its rows again in one task. What travels is the vocabulary of blocks, not the keys of every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A block ends after the row with which it has so many unknown keys, or has seen so many bytes of text.
BLOCK_KEYS, BLOCK_BYTES = 200_000, 64_000_000


def frequent(table: DataFrame, most: int, n: str = "n") -> DataFrame:
    """The rows of `table` with the largest `n`, at most `most` of them: all above a bound found by one grouping."""
    steps = table.groupBy(F.floor(8 * F.log2(F.col(n).cast("double"))).cast("int").alias("step")).count().collect()  # some hundred rows
    held, least = 0, None
    for r in sorted(steps, key=lambda r: -r["step"]):
        if held + r["count"] > most:
            break
        held, least = held + r["count"], r["step"]
    return table.where(F.floor(8 * F.log2(F.col(n).cast("double"))) >= least) if least is not None else table.limit(0)


def block_number(partition: int, at: int) -> int:
    """A number that no other block of the job has."""
    return (partition << 32) + at


def asked_type(row: T.StructType, key: T.DataType) -> T.StructType:
    """What a scoring task writes: rows with the numbers of their keys (32 bits each), and the keys of each block."""
    return T.StructType([
        T.StructField("block", T.LongType()), T.StructField("row", row), T.StructField("asks", T.BinaryType()), T.StructField("keys", T.ArrayType(key)),
    ])


def with_answers(asked: DataFrame, table: DataFrame, width: int) -> DataFrame:
    """`row`, `sums`, `answered` of all rows of `asked` (a written table of `asked_type`).

    `table` has unique `key` and `values`, `width` doubles. `sums` adds the values of a row's keys, repeated keys again;
    `answered` counts the keys (with repeats) that are in the table. Keys that are not there add nothing.
    """
    keys = asked.where(F.col("keys").isNotNull()).select("block", F.posexplode("keys").alias("place", "key"))
    found = keys.join(table.select("key", "values"), "key").select("block", "place", "values")
    row_type = asked.schema["row"].dataType
    answers = found.select("block", F.lit(0).alias("kind"), "place", "values", F.lit(None).cast(row_type).alias("row"), F.lit(None).cast("binary").alias("asks"))
    rows = asked.where(F.col("row").isNotNull()).select(
        "block", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("place"), F.lit(None).cast("array<double>").alias("values"), "row", "asks"
    )
    together = answers.unionByName(rows).repartition("block").sortWithinPartitions("block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, known, values = None, [], np.empty(0, dtype=np.int64), np.empty((0, width))
        for batch in batches:
            blocks = batch.column(0).to_numpy(zero_copy_only=False)
            kinds = batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if begin == end:
                    continue
                if blocks[begin] != at:
                    at, held, known, values = blocks[begin], [], np.empty(0, dtype=np.int64), np.empty((0, width))
                part = batch.slice(begin, end - begin)
                if not kinds[begin]:
                    held.append((part.column(2).to_numpy(zero_copy_only=False), part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)))
                    continue
                if held:
                    places, values = np.concatenate([h[0] for h in held]).astype(np.int64), np.vstack([h[1] for h in held])
                    known, held = np.full(places.max() + 1, -1, dtype=np.int64), []
                    known[places] = np.arange(len(places))
                yield _summed(part.column(4), part.column(5), known, values, width)

    schema = T.StructType([T.StructField("row", row_type), T.StructField("sums", T.ArrayType(T.DoubleType())), T.StructField("answered", T.LongType())])
    return together.mapInArrow(run, schema)


def _summed(rows: pa.Array, asks: pa.Array, known: np.ndarray, values: np.ndarray, width: int) -> pa.RecordBatch:
    numbers = [np.frombuffer(a, dtype="<i4") if a else np.empty(0, dtype="<i4") for a in asks.to_pylist()]
    sizes = np.array([len(n) for n in numbers], dtype=np.int64)
    every = np.concatenate(numbers) if numbers else np.empty(0, dtype="<i4")
    place = np.where(every < len(known), known[np.minimum(every, max(len(known) - 1, 0))], -1) if len(known) else np.full(len(every), -1)
    owner = np.repeat(np.arange(len(numbers)), sizes)[place >= 0]
    place = place[place >= 0]
    sums = np.stack([np.bincount(owner, values[place, k], len(numbers)) for k in range(width)], axis=1) if width else np.zeros((len(numbers), 0))
    lists = pa.FixedSizeListArray.from_arrays(pa.array(sums.reshape(-1)), width).cast(pa.list_(pa.float64()))
    answered = np.bincount(owner, minlength=len(numbers)).astype(np.int64)
    return pa.RecordBatch.from_arrays([rows, lists, pa.array(answered)], names=["row", "sums", "answered"])
