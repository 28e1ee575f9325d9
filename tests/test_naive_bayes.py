import math
import random
from collections import Counter

import pytest

from newsgraph.operators import classify as cl
from newsgraph.operators import naive_bayes as nb
from newsgraph.operators import splits as sp
from newsgraph.plans import triples as plan

SCHEMA = "id long, entity1 string, predicate string, entity2 string"


def made(count, seed, classes="abc"):
    rnd = random.Random(seed)
    vocabulary = {c: [f"{c}{i}" for i in range(6)] + ["the", "of"] for c in classes}
    rows = []
    for i in range(count):
        c = rnd.choice(classes)
        rows.append((i, " ".join(rnd.choice(vocabulary[rnd.choice([c, c, rnd.choice(classes)])]) for _ in range(rnd.randrange(0, 9))), c, ""))
    return rows


def brute(train, rows):
    words = lambda t: t.lower().split()[:128]
    unit = lambda x: math.floor(x * nb.UNIT + 0.5)
    sizes, counts = Counter(r[2] for r in train), Counter((r[2], w) for r in train for w in words(r[1]))
    known = {w for _, w in counts}
    out = {}
    for i, text, *_ in rows:
        mine = [w for w in words(text) if w in known]
        best = []
        for c in sizes:
            tokens = sum(n for (k, _), n in counts.items() if k == c)
            score = unit(math.log(sizes[c] / len(train))) - len(mine) * unit(math.log(tokens + len(known)))
            best.append((-(score + sum(unit(math.log(counts[c, w] + 1)) for w in mine)), c))
        out[i] = min(best)[1]
    return out


@pytest.mark.parametrize("hot_rows", [10_000_000, 3])
def test_predictions_equal_the_definition(spark, hot_rows):
    train, rows = made(120, 1), made(60, 2) + [(900, "never seen", "a", ""), (901, "", "a", ""), (902, "a1 " * 500, "a", "")]
    model = nb.train(spark.createDataFrame(train, SCHEMA).repartition(3))
    frame = spark.createDataFrame(rows + rows[:2], SCHEMA).repartition(4)
    found = nb.predict(model, frame.drop("predicate"), hot_rows=hot_rows).collect()
    truth = brute(train, rows)
    assert len(found) == len(rows) + 2 and {r["id"]: r["predicted"] for r in found} == truth
    assert found[0].asDict().keys() == {"id", "entity1", "entity2", "predicted"}


def test_ties_go_to_the_class_that_sorts_first(spark):
    model = nb.train(spark.createDataFrame([(1, "x", "b", ""), (2, "x", "a", ""), (3, "y", "c", "")], SCHEMA))
    found = nb.predict(model, spark.createDataFrame([(1, "x", "", ""), (2, "nothing", "", ""), (3, None, "", "")], SCHEMA).drop("predicate"))
    assert {r["id"]: r["predicted"] for r in found.collect()} == {1: "a", 2: "a", 3: "a"}


def test_scores(spark):
    confusion = spark.createDataFrame([("a", "a", 6), ("a", "b", 2), ("b", "b", 3), ("b", "a", 1)], "predicate string, predicted string, n long")
    found = {r["metric"]: r["value"] for r in nb.scores(confusion).collect()}
    assert found["accuracy"] == pytest.approx(9 / 12)
    assert found["f1"] == pytest.approx((12 / 15 * 8 + 6 / 9 * 4) / 12)


def test_flow_from_splits_to_scores(spark, tmp_path):
    splits = plan.with_small_train(sp.stratified_split(spark.createDataFrame(made(600, 4), SCHEMA)))
    done = plan.train_and_score(splits, str(tmp_path / "model"))
    predictions = done["predictions"]
    assert predictions.count() == splits.where("split = 'valid'").count()
    assert {r["metric"]: r["value"] for r in done["scores"].collect()}["accuracy"] > 0.5
    again = nb.predict(nb.read_model(spark, str(tmp_path / "model")), splits.where("split = 'valid'"))
    assert sorted(map(tuple, again.select("id", "predicted").collect())) == sorted(map(tuple, predictions.select("id", "predicted").collect()))
    assert cl.confusion(again).agg({"n": "sum"}).first()[0] == predictions.count()
    unseen = splits.unionByName(spark.createDataFrame([(9999, "z", "zz", "", "valid")], splits.schema))
    with pytest.raises(ValueError, match="not seen in training: zz"):
        plan.train_and_score(unseen, str(tmp_path / "other"))


def test_nothing_to_train_on(spark):
    model = nb.train(spark.createDataFrame([(1, None, "a", ""), (2, "x", None, "")], SCHEMA))
    found = nb.predict(model, spark.createDataFrame([(1, "x", "a", "")], SCHEMA)).collect()
    assert [r["predicted"] for r in found] == [None]
