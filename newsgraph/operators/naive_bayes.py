"""Relation classifier whose model is two tables: multinomial naive Bayes, trained by grouping, scored by join and sum.

Nothing of the model is on the driver, so classes and terms may be as many as they like. All scores are whole numbers
(millionths of a natural logarithm): sums come out the same in any order, and ties go to the class that sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.operators.classify import classifier_input
from newsgraph.operators.scale import HOT_ROWS, broadcast_if_small, lookup_join
from newsgraph.scratch import materialise
from newsgraph.sources.readers import require_columns

UNIT = 1_000_000


@dataclass
class Model:
    """`terms` (term, predicate, gain, n_term): what a term adds to a class; `classes` (predicate, prior, share)."""

    terms: DataFrame
    classes: DataFrame


def _units(value: Column) -> Column:
    return F.round(value * UNIT).cast("long")


def train(rows: DataFrame, both_entities: bool = False) -> Model:
    """The model of labelled rows: add-one counts of terms by class.

    A row scores ln(rows of the class / rows) + sum of ln((n + 1) / (tokens of the class + terms)) over its known terms.
    The part with n + 1 is `gain`, which is 0 for a term that the class does not have, so only pairs that occur are kept;
    the rest, `share`, is the same for every known term.
    """
    require_columns(rows, ["entity1", "predicate"])
    kept = materialise(classifier_input(rows.dropna(subset=["entity1", "predicate"]), both_entities).select("predicate", "words"), "training-rows")
    counts = materialise(kept.select("predicate", F.explode("words").alias("term")).groupBy("term", "predicate").agg(F.count(F.lit(1)).alias("n")), "class-terms")
    totals = materialise(counts.groupBy("term").agg(F.sum("n").alias("n_term")), "model-term-totals")
    tokens = counts.groupBy("predicate").agg(F.sum("n").alias("tokens"))
    sizes = kept.groupBy("predicate").agg(F.count(F.lit(1)).alias("n")).join(tokens, "predicate", "left")
    classes = sizes.select(
        "predicate", _units(F.log(F.col("n") / F.lit(kept.count()))).alias("prior"),
        _units(F.log((F.coalesce("tokens", F.lit(0)) + F.lit(totals.count())).cast("double"))).alias("share"),
    )
    terms = lookup_join(counts, totals, "term", "n_term", ["predicate"]).select("term", "predicate", _units(F.log(F.col("n") + 1.0)).alias("gain"), "n_term")
    return Model(materialise(terms, "model-terms"), materialise(classes, "model-classes"))


def predict(model: Model, rows: DataFrame, both_entities: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add `predicted`; rows without a known term get the class that is best without any.

    Only classes that share a term with a row are scored for it one by one. Of the others the best depends on the number of
    known terms alone, which is at most 128, so it comes from a table of that many rows.
    """
    numbered = materialise(classifier_input(rows, both_entities).withColumn("_row", F.monotonically_increasing_id()), "scored-rows")
    words = numbered.select("_row", F.explode("words").alias("term")).groupBy("_row", "term").agg(F.count(F.lit(1)).alias("_times"))
    known = materialise(lookup_join(words, model.terms, "term", "n_term", ["_row"], hot_rows=hot_rows), "known-terms")
    lengths = known.select("_row", "term", "_times").distinct().groupBy("_row").agg(F.sum("_times").alias("_known"))
    gains = known.groupBy("_row", "predicate").agg(F.sum(F.col("_times") * F.col("gain")).alias("_gain"))
    classes = broadcast_if_small(model.classes)
    scored = gains.join(lengths, "_row").join(classes, "predicate").select(
        "_row", (F.col("prior") - F.col("_known") * F.col("share") + F.col("_gain")).alias("_score"), "predicate"
    )
    best = F.min(F.struct((-F.col("_score")).alias("s"), F.col("predicate").alias("predicted")))
    by_length = model.classes.select("predicate", F.explode(F.sequence(F.lit(0), F.lit(lx.MAX_CLASSIFIER_TOKENS))).alias("_known"), "prior", "share")
    by_length = by_length.withColumn("_score", F.col("prior") - F.col("_known") * F.col("share")).groupBy("_known").agg(best.alias("_plain"))
    winners = scored.groupBy("_row").agg(best.alias("_own"))
    joined = numbered.join(lengths, "_row", "left").join(winners, "_row", "left").withColumn("_known", F.coalesce("_known", F.lit(0)))
    joined = joined.join(F.broadcast(by_length), "_known", "left")  # a row for each length
    return joined.withColumn("predicted", F.least("_own", "_plain")["predicted"]).drop("words", "_row", "_known", "_own", "_plain")


def check_labels(model: Model, rows: DataFrame) -> DataFrame:
    """`rows`, or an error that names a label that the model has not seen."""
    unseen = rows.select("predicate").distinct().join(model.classes, "predicate", "left_anti").first()
    if unseen:
        raise ValueError(f"label not seen in training: {unseen['predicate']}")
    return rows


def scores(confusion: DataFrame) -> DataFrame:
    """(metric, value): accuracy and F1 weighted by class, of a table (predicate, predicted, n)."""
    told = confusion.groupBy(F.col("predicate").alias("name")).agg(F.sum("n").alias("told"), F.sum(F.when(F.col("predicate") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hits"))
    said = confusion.groupBy(F.col("predicted").alias("name")).agg(F.sum("n").alias("said"))
    classes = told.join(said, "name", "left")
    f1 = 2 * F.col("hits") / (F.col("told") + F.coalesce("said", F.lit(0)))
    sums = classes.agg(F.sum("told").alias("rows"), F.sum("hits").alias("hits"), F.sum(f1 * F.col("told")).alias("f1"))
    pairs = F.array(F.struct(F.lit("accuracy").alias("metric"), (F.col("hits") / F.col("rows")).alias("value")),
                    F.struct(F.lit("f1").alias("metric"), (F.col("f1") / F.col("rows")).alias("value")))
    return sums.select(F.inline(pairs))


def write_model(model: Model, path: str) -> None:
    """Both tables of the model, one folder each."""
    model.terms.write.mode("overwrite").parquet(f"{path}/terms")
    model.classes.write.mode("overwrite").parquet(f"{path}/classes")


def read_model(spark: SparkSession, path: str) -> Model:
    return Model(spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/classes"))
