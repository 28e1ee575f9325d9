"""Labelled triples to splits, label codes and a trained relation classifier."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.operators import classify, naive_bayes
from newsgraph.operators import splits as sp
from newsgraph.scratch import materialise
from newsgraph.sources.readers import alias_headers, normalise_headers, require_columns


def prepare_triples(table: DataFrame, identity: str | None = None, seed: int = lx.SEED) -> DataFrame:
    """Header names, missing and rare rows handled, and every row put into train, valid or test.

    Without an identity column rows are numbered and written to the shared folder once.
    """
    rows = require_columns(alias_headers(normalise_headers(table)), ["entity1", "predicate", "entity2"])
    if identity is None:
        rows = materialise(rows.withColumn("id", F.monotonically_increasing_id()), "triples")
        identity = "id"
    kept = sp.require_rows(sp.drop_rare_classes(sp.drop_missing(rows)))
    return sp.split(kept, identity, "predicate", seed)


def with_small_train(splits: DataFrame, identity: str = "id", fraction: float = 0.05, seed: int = lx.SEED) -> DataFrame:
    """The split table plus a 5 % sample of train as the split `train_small`."""
    small = sp.sample_fraction(splits.where("split = 'train'"), identity, fraction, seed)
    return splits.unionByName(small.withColumn("split", F.lit("train_small")))


def train_relation_classifier(train: DataFrame, valid: DataFrame, both_entities: bool = False) -> tuple[PipelineModel, dict[str, float]]:
    """Model fitted on `train` and its scores on `valid`; a label of `valid` that train lacks is an error."""
    model = classify.train(train, both_entities)
    return model, classify.evaluate(model, valid, both_entities)


def train_and_score(splits: DataFrame, path: str, train: str = "train_small", score: str = "valid") -> dict[str, DataFrame]:
    """Train a table model on one split, save it, load it and score another one: predictions, confusion and scores.

    `splits` is what `with_small_train` gives. A label of the scored split that the training split lacks is an error.
    """
    naive_bayes.write_model(naive_bayes.train(splits.where(F.col("split") == train)), path)
    model = naive_bayes.read_model(splits.sparkSession, path)
    rows = naive_bayes.check_labels(model, splits.where(F.col("split") == score))
    predictions = materialise(naive_bayes.predict(model, rows), "predictions")
    confusion = classify.confusion(predictions)
    return {"predictions": predictions, "confusion": confusion, "scores": naive_bayes.scores(confusion)}
