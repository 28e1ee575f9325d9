"""Article, sentence and triple tables from files, and the checks on their columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.functions import text as tx
from newsgraph.operators.scale import range_rank

TRIPLE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("Entity1", "Predicate", "Entity2")])

# --- fixed values: accepted header aliases ---
HEADER_ALIASES = {
    "subject": "entity1", "head": "entity1",
    "relation": "predicate", "relationtype": "predicate",
    "object": "entity2", "tail": "entity2",
}

_FORMATS = {"csv": "csv", "tsv": "tsv", "txt": "txt", "json": "json", "jsonl": "json", "parquet": "parquet", "orc": "orc"}
_COMPRESSIONS = ("gz", "bz2", "zst", "snappy")


def format_of(path: str) -> str:
    """Format by suffix; a compression suffix is looked through. Anything unknown is an error."""
    parts = path.rstrip("/").rsplit("/", 1)[-1].lower().split(".")
    if len(parts) > 2 and parts[-1] in _COMPRESSIONS:
        parts.pop()
    suffix = parts[-1] if len(parts) > 1 else ""
    if suffix in ("xlsx", "xls"):
        raise ValueError(f"Spark has no Excel source: save {path} as csv or parquet")
    if suffix not in _FORMATS:
        raise ValueError(f"unsupported file format: {path}")
    return _FORMATS[suffix]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def _load(
    spark: SparkSession, path: str, fmt: str | None, schema: T.StructType | str | None, multiline: bool = True
) -> DataFrame:
    fmt = fmt or format_of(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt in ("csv", "tsv"):
        # Quotes are doubled and fields may span lines, as spreadsheet exports have it. Such a file is read by one task:
        # for large files without line breaks in fields pass multiline=False, or use parquet.
        reader = reader.option("header", True).option("multiLine", multiline).option("escape", '"').option("sep", "\t" if fmt == "tsv" else ",")
        return reader.csv(path)
    if fmt not in ("json", "parquet", "orc"):
        raise ValueError(f"unsupported table format: {fmt}")
    return reader.format(fmt).load(path)


def in_file_order(table: DataFrame, fields: Iterable[Column], number: str) -> DataFrame:
    """`fields` of a table just loaded from files, numbered from 0 by file name, block and row in the block.

    Spark deals files to tasks by size, so a task's number says nothing about the order; inside a block rows keep it.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    rows = table.select(*fields, *place, F.monotonically_increasing_id().alias("_row"))
    ranked = range_rank(rows, [], [F.col("_file"), F.col("_block"), F.col("_row")], name=number)
    return ranked.withColumn(number, F.col(number).cast("long") - 1).drop("_file", "_block", "_row")


def read_articles(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    text: str = "Text",
    link: str = "Link",
    identity: str | None = None,
    schema: T.StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """(article_id, ord, url, text) with null texts as ''.

    `identity` names a BIGINT column that numbers the articles. Without one, rows are numbered from 0 in the order of
    files by name and of rows in a file, and written to the shared folder once. `multiline` reads CSV fields with line
    breaks, one task per file; switch it off for large files without them.
    """
    table = require_columns(_load(spark, path, fmt, schema, multiline), [text, link])
    fields = [F.col(link).cast("string").alias("url"), tx.filled(F.col(text)).alias("text")]
    if identity:
        require_columns(table, [identity])
        rows = table.select(F.col(identity).cast("long").alias("article_id"), *fields)
    else:
        rows = in_file_order(table, fields, "article_id")
    return rows.select("article_id", F.col("article_id").alias("ord"), "url", "text")


def read_sentences(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None, multiline: bool = True
) -> DataFrame:
    """Table with a Sentence column, chosen by suffix: .txt is header-less triples, other formats need `Sentence`."""
    fmt = fmt or format_of(path)
    if fmt == "txt":
        return read_triples_text(spark, path)
    table = require_columns(_load(spark, path, fmt, schema, multiline), ["Sentence"])
    return table.withColumn("Sentence", tx.filled(F.col("Sentence")))


def read_triples_text(spark: SparkSession, path: str) -> DataFrame:
    """Header-less tab-separated triples with their Sentence. A row with a missing part gets an empty sentence."""
    triples = spark.read.schema(TRIPLE_SCHEMA).option("sep", "\t").csv(path)
    sentence = tx.sentence_of(F.col("Entity1"), F.col("Predicate"), F.col("Entity2"))
    return triples.withColumn("Sentence", tx.filled(sentence))


def normalise_headers(df: DataFrame) -> DataFrame:
    """Column names stripped and in lower case; two names that become one are an error."""
    names = [c.strip().lower() for c in df.columns]
    _reject_duplicates(names)
    return df.toDF(*names)


def alias_headers(df: DataFrame) -> DataFrame:
    """subject/head -> entity1, relation/relationtype -> predicate, object/tail -> entity2."""
    names = [HEADER_ALIASES.get(c, c) for c in df.columns]
    _reject_duplicates(names)
    return df.toDF(*names)


def _reject_duplicates(names: list[str]) -> None:
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several columns would be named: {', '.join(twice)}")


def read_labelled_triples(spark: SparkSession, path: str, fmt: str = "csv", multiline: bool = True) -> DataFrame:
    """Labelled triples with a header in any of the accepted spellings."""
    table = alias_headers(normalise_headers(_load(spark, path, fmt, None, multiline)))
    return require_columns(table, ["entity1", "predicate", "entity2"])


def read_splits(spark: SparkSession, path: str, names: Iterable[str] = ("train_small", "valid")) -> dict[str, DataFrame]:
    """Splits written by `sinks.write_splits`; a missing one is an error."""
    table = spark.read.parquet(path)
    require_columns(table, ["split", "entity1", "predicate", "entity2"])
    out = {}
    for name in names:
        part = table.where(F.col("split") == name).drop("split")
        if part.isEmpty():
            raise FileNotFoundError(f"split {name} not found in {path}")
        out[name] = part
    return out
