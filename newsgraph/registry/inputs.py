"""The operators' inputs, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph import lexicon as lx
from newsgraph.functions import text as tx
from newsgraph.operators.scale import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as (article_id, ord, url, text)."""
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("article_id"), F.col("doc_id").alias("ord"),
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("url"), "text",
    )
    return spread(rows, "article_id")


def _item_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, term): every one to four consecutive words of every sentence of benchmark, in lower case."""
    items = table(spark, sf_dir, "benchmark")
    sentences = items.select("item_id", F.explode(tx.sentences(F.col("text"))).alias("s"))
    words = sentences.select("item_id", tx.word_tokens(F.col("s")).alias("t")).where("size(t) > 0")
    starts = words.select("item_id", "t", F.explode(F.sequence(F.lit(1), F.size("t"))).alias("i"))
    grams = starts.select("item_id", "t", "i", F.explode(F.array(*[F.lit(n) for n in (1, 2, 3, 4)])).alias("n"))
    grams = grams.where("size(t) >= i + n - 1").select("item_id", F.slice("t", F.col("i"), F.col("n")).alias("g"))
    words_only = F.forall("g", lambda w: w.rlike(rf"^[{lx.WORD}]+$"))
    return grams.where(words_only).select("item_id", F.lower(F.array_join("g", " ")).alias("term"))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term, label): runs of words of benchmark; the label goes by the term's length."""
    types = F.array(*[F.lit(t) for t in lx.ENTITY_TYPES])
    terms = _item_grams(spark, sf_dir).select("term").distinct()
    return terms.select("term", F.get(types, F.char_length("term") % len(lx.ENTITY_TYPES)).alias("label"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, item, score): words and runs of words of benchmark, one candidate per item that has them.

    Terms in e or o have no score, two-letter terms no item, and long terms carry a trailing blank.
    """
    items = table(spark, sf_dir, "benchmark")
    words = items.select("item_id", F.explode(tx.split_blank(F.lower(tx.strip_special(F.col("text"))))).alias("term"))
    counted = words.union(_item_grams(spark, sf_dir)).groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.when(F.char_length("term") > 5, F.concat("term", F.lit(" "))).otherwise(F.col("term")).alias("label"),
        F.when(F.char_length("term") != 2, F.concat(F.lit("Q"), F.col("item_id").cast("string"))).alias("item"),
        F.when(~F.substring("term", 1, 1).isin("e", "o"), F.col("n") / (F.col("n") + 2)).alias("score"),
    )


def misspelt(labels: DataFrame) -> DataFrame:
    """A catalogue with the third letter of every label of six or more doubled, so that it has to be searched."""
    return labels.withColumn("label", F.when(
        F.char_length(F.trim("label")) >= 6, F.concat(F.substring("label", 1, 3), F.expr("substring(label, 3)"))).otherwise(F.col("label")))


def all_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as sentences with an id, every turn with its text."""
    return table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("article_id"), F.col("text").alias("Sentence"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as sentences with an id; the user's turns are null, for what fills or skips nulls."""
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("article_id"),
        F.when(F.col("role") != "user", F.col("text")).alias("Sentence"),
    )


def labelled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as labelled triples (id, entity1, predicate, entity2)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("entity1"),
        F.col("event_type").alias("predicate"), F.col("props").alias("entity2"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("article_id"), "embedding")


def longs(df: DataFrame) -> DataFrame:
    """All int columns as bigint, the type the checking SQL gives."""
    return df.select([
        F.col(f.name).cast("long").alias(f.name) if isinstance(f.dataType, T.IntegerType) else F.col(f.name)
        for f in df.schema
    ])
