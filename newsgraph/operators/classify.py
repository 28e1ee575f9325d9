"""Relation classifier: predicate from the text of entity1, as a pyspark.ml pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, IndexToString, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.functions import text as tx
from newsgraph.scratch import materialise
from newsgraph.sources.readers import require_columns

# The coefficient matrix (classes x features) is the one thing the driver holds.
MAX_COEFFICIENTS = 20_000_000


def classifier_input(rows: DataFrame, both_entities: bool = False) -> DataFrame:
    """Add `words`: at most 128 lower-case tokens of entity1, or of both entities."""
    text = F.concat_ws(" ", "entity1", "entity2") if both_entities else F.col("entity1")
    return rows.withColumn("words", tx.capped_tokens(F.lower(text.cast("string")), lx.MAX_CLASSIFIER_TOKENS))


def train(train_rows: DataFrame, both_entities: bool = False, features: int = 1 << 16, max_iter: int = 30) -> PipelineModel:
    """Fit label codes (alphabetical, on the training rows only) and a multinomial logistic regression."""
    require_columns(train_rows, ["entity1", "predicate", "entity2"])
    # the class count, the label codes, the IDF and the fit all read these rows
    rows = materialise(classifier_input(train_rows.dropna(subset=["entity1", "predicate"]), both_entities), "training-rows")
    classes = rows.select("predicate").distinct().count()
    if classes * features > MAX_COEFFICIENTS:
        raise ValueError(f"{classes} classes x {features} features are too many coefficients for one model: ask for fewer features")
    indexer = StringIndexer(inputCol="predicate", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="error")
    indexer_model = indexer.fit(rows)
    stages = [
        HashingTF(inputCol="words", outputCol="counts", numFeatures=features),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(family="multinomial", maxIter=max_iter, regParam=0.01),
    ]
    model = Pipeline(stages=stages).fit(indexer_model.transform(rows))
    return PipelineModel([indexer_model, *model.stages])


def predict(model: PipelineModel, rows: DataFrame, both_entities: bool = False) -> DataFrame:
    """Add `prediction` and its decoded `predicted`. Rows need no predicate: the label stage is left out."""
    indexer, *stages = model.stages
    scored = PipelineModel(stages).transform(classifier_input(rows, both_entities))
    decode = IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)
    return decode.transform(scored).drop("words", "counts", "features", "rawPrediction", "probability")


def evaluate(model: PipelineModel, valid: DataFrame, both_entities: bool = False) -> dict[str, float]:
    """Accuracy and weighted F1 on labelled rows; a label unseen in training is an error."""
    rows = classifier_input(valid.dropna(subset=["entity1"]), both_entities)
    scored = model.transform(rows).select("label", "prediction")
    return {
        name: MulticlassClassificationEvaluator(metricName=name).evaluate(scored)
        for name in ("accuracy", "f1")
    }


def confusion(predictions: DataFrame) -> DataFrame:
    """(predicate, predicted, n)."""
    return predictions.groupBy("predicate", "predicted").agg(F.count(F.lit(1)).alias("n"))
