"""Small helpers for operators that work on Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# A task handles at most about so many characters at once; one longer text is a piece of its own.
PIECE_CHARS = 1_000_000


def fresh_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores in front until no column of `df` is called so (names clash regardless of case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def slices(batch: pa.RecordBatch, text: str, chars: int = PIECE_CHARS) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch whose `text` column has about `chars` bytes; a longer row stands alone."""
    column = batch.column(batch.schema.get_field_index(text))
    start, held = 0, 0
    for row in range(batch.num_rows):
        size = len(column[row].as_buffer() or b"") if column[row].is_valid else 0
        if row > start and held + size > chars:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def map_texts(
    df: DataFrame, text: str, outputs: list[tuple[str, T.DataType, pa.DataType]], apply: Callable[[list], Iterable[list]]
) -> DataFrame:
    """Add columns computed from `text` by `apply`, which gets the values of a slice and returns one list per output.

    Every other column passes through unchanged, whatever its type.
    """
    names = [name for name, _, _ in outputs]
    schema = T.StructType([*df.schema.fields, *[T.StructField(name, kind) for name, kind, _ in outputs]])
    arrow_types = [kind for _, _, kind in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                columns = apply(part.column(part.schema.get_field_index(text)).to_pylist())
                added = [pa.array(values, kind) for values, kind in zip(columns, arrow_types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, *names])

    return df.mapInArrow(run, schema)
