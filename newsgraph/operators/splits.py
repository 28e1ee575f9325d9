"""Deterministic train / valid / test splits, class filters and label codes for labelled triples.

A row's place is decided by the md5 of the seed and its id. The hash is uniform, so its first hex digits cut any class
into even buckets: ranks come from bucket counts, and no task ever sorts a whole class or table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.operators.scale import HOT_ROWS, bucketed_rank, lookup_join, range_rank
from newsgraph.scratch import materialise

BUCKET_DIGITS = 4


def drop_missing(triples: DataFrame) -> DataFrame:
    return triples.dropna(subset=["entity1"])


def class_counts(triples: DataFrame, label: str = "predicate") -> DataFrame:
    return triples.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def drop_rare_classes(triples: DataFrame, label: str = "predicate", at_least: int = 2, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of classes with at least `at_least` rows.

    A window per class would put the largest class into one task; here the counts are joined back, and the rows of a
    large class are salted over several tasks. A null class is counted like any other.
    """
    keyed = triples.withColumn("_class", F.coalesce(F.col(label), F.lit("\u0000")))
    kept = class_counts(keyed, "_class").where(F.col("n") >= at_least).withColumnRenamed("n", "_class_rows")
    kept = materialise(kept, "class-counts")
    joined = lookup_join(keyed, kept, "_class", "_class_rows", triples.columns, hot_rows=hot_rows)
    return joined.select(triples.columns)


def require_rows(df: DataFrame, message: str = "no rows left after filtering") -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def _hash(identity: Column, seed: int, salt: str = "") -> Column:
    parts = [F.lit(str(seed)), identity.cast("string")]
    if salt:
        parts.insert(0, F.lit(salt))
    return F.md5(F.concat_ws("|", *parts))


def _ranked(rows: DataFrame, identity: str, groups: list[str], seed: int, salt: str, rank: str, total: str) -> DataFrame:
    hashed = rows.withColumn("_h", _hash(F.col(identity), seed, salt))
    out = bucketed_rank(hashed, [F.col("_h"), F.col(identity)], F.substring("_h", 1, BUCKET_DIGITS), groups, rank, total)
    return out.drop("_h")


def _split_name(rank: Column, total: Column, held_out: Column) -> Column:
    """Ranks up to total - held_out train; the rest is halved, the larger half going to test."""
    test = F.floor((held_out + 1) / 2)
    return F.when(rank <= total - held_out, "train").when(rank <= total - test, "valid").otherwise("test")


def stratified_split(rows: DataFrame, identity: str = "id", label: str = "predicate", seed: int = lx.SEED) -> DataFrame:
    """Add `split`: 80/10/10 inside every class. A class of m rows holds out round(0.2 m) rows."""
    ranked = _ranked(rows, identity, [label], seed, "", "_rank", "_total")
    held_out = F.floor((F.col("_total") * 2 + 5) / 10)
    return ranked.withColumn("split", _split_name(F.col("_rank"), F.col("_total"), held_out)).drop("_rank", "_total")


def random_split(rows: DataFrame, identity: str = "id", seed: int = lx.SEED) -> DataFrame:
    """Add `split`: 80/10/10 over all rows, ceil(0.2 n) held out."""
    ranked = _ranked(rows, identity, [], seed, "", "_rank", "_total")
    held_out = F.floor((F.col("_total") * 2 + 9) / 10)
    return ranked.withColumn("split", _split_name(F.col("_rank"), F.col("_total"), held_out)).drop("_rank", "_total")


def can_stratify(rows: DataFrame, label: str = "predicate") -> bool:
    """Whether every class leaves two rows for the held-out part and each half of it has room for all classes."""
    held_out = F.floor((F.col("n") * 2 + 5) / 10)
    facts = class_counts(rows, label).agg(
        F.min(held_out).alias("least"), F.sum(held_out).alias("held"), F.count(F.lit(1)).alias("classes")
    ).first()
    return facts["classes"] > 0 and facts["least"] >= 2 and facts["held"] // 2 >= facts["classes"]


def split(rows: DataFrame, identity: str = "id", label: str = "predicate", seed: int = lx.SEED) -> DataFrame:
    """Stratified split, or the plain random one where stratification is impossible."""
    if can_stratify(rows, label):
        return stratified_split(rows, identity, label, seed)
    return random_split(rows, identity, seed)


def sample_fraction(rows: DataFrame, identity: str = "id", fraction: float = 0.05, seed: int = lx.SEED) -> DataFrame:
    """round(fraction * n) rows, chosen by a hash of their own so that they are no prefix of the split order."""
    ranked = _ranked(rows, identity, [], seed, "sample", "_rank", "_total")
    return ranked.where(F.col("_rank") <= F.round(F.lit(fraction) * F.col("_total"))).drop("_rank", "_total")


def label_codes(train: DataFrame, label: str = "predicate") -> DataFrame:
    """(label, code): alphabetical codes from 0, fitted on the training rows.

    The distinct labels are ranked by range partitions, so their number is not bound to one task.
    """
    distinct = train.select(label).distinct().where(F.col(label).isNotNull())
    ranked = range_rank(distinct, [], [F.col(label)], "_rank")
    return ranked.select(label, (F.col("_rank") - 1).cast("int").alias("code"))


def encode_labels(rows: DataFrame, codes: DataFrame, label: str = "predicate", unseen: str = "error") -> DataFrame:
    """Add `code`. A label without a code fails the query, or gets the next free code with unseen='keep'."""
    joined = rows.join(codes, label, "left")
    if unseen == "keep":
        size = codes.agg(F.count(F.lit(1)).cast("int")).scalar()
        return joined.withColumn("code", F.coalesce(F.col("code"), size))
    failure = F.raise_error(F.concat(F.lit("label not seen in training: "), F.coalesce(F.col(label), F.lit("null"))))
    return joined.withColumn("code", F.coalesce(F.col("code"), failure.cast("int")))
