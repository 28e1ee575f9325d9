import pytest
from pyspark.sql import functions as F

from newsgraph.operators import classify as cl
from newsgraph.operators import splits as sp
from newsgraph.plans import triples as plan
from newsgraph.sources import sinks


def labelled(spark, sizes):
    rows = [(i * 10_000 + j, f"word{i} name{j % 3}", p, "x") for i, (p, n) in enumerate(sizes.items()) for j in range(n)]
    return spark.createDataFrame(rows, "id long, entity1 string, predicate string, entity2 string")


def shares(frame):
    return {(r["predicate"], r["split"]): r["n"] for r in frame.groupBy("predicate", "split").agg(F.count("*").alias("n")).collect()}


def test_stratified_shares_and_cover(spark):
    frame = labelled(spark, {"a": 100, "b": 50, "c": 13})
    done = sp.stratified_split(frame)
    assert shares(done) == {
        ("a", "train"): 80, ("a", "valid"): 10, ("a", "test"): 10, ("b", "train"): 40, ("b", "valid"): 5, ("b", "test"): 5,
        ("c", "train"): 10, ("c", "valid"): 1, ("c", "test"): 2}
    assert done.count() == done.select("id").distinct().count() == 163


def test_split_does_not_depend_on_partitions(spark, rows):
    frame = labelled(spark, {"a": 60, "b": 40})
    assert rows(sp.split(frame.repartition(7)), "id", "split") == rows(sp.split(frame.coalesce(1)), "id", "split")


def test_fallback_to_random_split(spark):
    frame = labelled(spark, {"a": 100, "b": 3})
    assert not sp.can_stratify(frame) and sp.can_stratify(labelled(spark, {"a": 100, "b": 20}))
    counts = {r["split"]: r["n"] for r in sp.split(frame).groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert counts == {"train": 82, "valid": 10, "test": 11}


def test_null_class_and_rare_classes(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "id long, predicate string")
    for hot_rows in (1, 10**7):
        assert sorted(r["id"] for r in sp.drop_rare_classes(frame, hot_rows=hot_rows).collect()) == [1, 2, 4, 5]


def test_nothing_left_is_an_error(spark):
    with pytest.raises(ValueError, match="no rows left"):
        plan.prepare_triples(labelled(spark, {"a": 1, "b": 1}), "id")


def test_small_train_is_a_sample_of_train(spark):
    done = plan.with_small_train(sp.stratified_split(labelled(spark, {"a": 500, "b": 300})))
    train = {r["id"] for r in done.where("split = 'train'").collect()}
    small = {r["id"] for r in done.where("split = 'train_small'").collect()}
    assert len(train) == 640 and len(small) == 32 and small < train


def test_label_codes_are_alphabetical_on_train(spark, rows):
    frame = labelled(spark, {"b": 3, "a": 2, "ab": 1, "é": 1})
    codes = sp.label_codes(frame)
    assert rows(codes) == [("a", 0), ("ab", 1), ("b", 2), ("é", 3)]
    unseen = labelled(spark, {"z": 1})
    with pytest.raises(Exception, match="not seen in training"):
        sp.encode_labels(unseen, codes).collect()
    assert sp.encode_labels(unseen, codes, unseen="keep").first()["code"] == 4


def test_classifier_learns_saves_and_scores(spark, tmp_path):
    frame = labelled(spark, {"a": 60, "b": 60})
    splits = sp.stratified_split(frame)
    train, valid = splits.where("split = 'train'"), splits.where("split = 'valid'")
    model, scores = plan.train_relation_classifier(train, valid)
    assert scores["accuracy"] == 1.0
    sinks.write_model(model, str(tmp_path / "model"))
    loaded = sinks.read_model(str(tmp_path / "model"))
    done = cl.predict(loaded, valid)
    assert done.where("predicted = predicate").count() == valid.count()
    assert {tuple(r)[:2] for r in cl.confusion(done).collect()} == {("a", "a"), ("b", "b")}
    with pytest.raises(Exception):
        cl.evaluate(model, labelled(spark, {"z": 2}))
