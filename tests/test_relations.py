import pytest
from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.functions import annotate as an
from newsgraph.operators import relations as rl

SCHEMA = "article_id long, sent int, i int, text string, lemma string, pos string, dep string, head_i int, is_stop boolean, is_punct boolean"


def token(i, text, dep, head, sent=0, article=1, lemma=None):
    return (article, sent, i, text, lemma or text, "X", dep, head, False, False)


def relations(spark, *tokens):
    frame = spark.createDataFrame(list(tokens), SCHEMA)
    return [tuple(r) for r in rl.relations_of_tokens(frame).orderBy("article_id", "sent", "pos").select("subject", "predicate", "object").collect()]


def test_first_left_subject_and_first_right_object(spark):
    got = relations(
        spark, token(0, "s1", "nsubj", 2), token(1, "s2", "nsubj", 2), token(2, "is", "ROOT", 2),
        token(3, "o1", "pobj", 2), token(4, "o2", "dobj", 2))
    assert got == [("s1", "is", "o1")]


def test_passive_subject_counts_and_sides_matter(spark):
    assert relations(spark, token(0, "s", "nsubjpass", 1), token(1, "v", "ROOT", 1), token(2, "o", "dobj", 1)) == [("s", "v", "o")]
    assert relations(spark, token(0, "o", "dobj", 1), token(1, "v", "ROOT", 1), token(2, "s", "nsubj", 1)) == []
    assert relations(spark, token(0, "v", "ROOT", 0), token(1, "o", "dobj", 0)) == []


def test_children_of_other_heads_are_ignored(spark):
    got = relations(
        spark, token(0, "s", "nsubj", 1), token(1, "v", "ROOT", 1), token(2, "x", "prep", 1), token(3, "o", "pobj", 2),
        token(4, "s", "nsubj", 5, 1), token(5, "w", "ROOT", 5, 1), token(6, "o", "dobj", 5, 1))
    assert got == [("s", "w", "o")]


# confidence by distance from 2 to 11, with and without the bonus of the lemma
CONFIDENCES = {
    'be': [0.7, 0.6499999999999999, 0.5999999999999999, 0.5499999999999999, 0.49999999999999994, 0.49999999999999994, 0.49999999999999994, 0.49999999999999994, 0.49999999999999994, 0.49999999999999994],
    'say': [0.6, 0.5499999999999999, 0.49999999999999994, 0.44999999999999996, 0.39999999999999997, 0.39999999999999997, 0.39999999999999997, 0.39999999999999997, 0.39999999999999997, 0.39999999999999997],
}


@pytest.mark.parametrize("lemma", ["be", "say"])
def test_confidence_to_the_last_bit(spark, lemma):
    frame = spark.range(2, 12).withColumn("c", an.relation_confidence(F.col("id"), F.lit(lemma)))
    assert [r["c"] for r in frame.orderBy("id").collect()] == CONFIDENCES[lemma]


def test_distance_six_without_bonus_is_below_the_threshold(spark):
    frame = spark.range(5, 8).withColumn("confidence", an.relation_confidence(F.col("id"), F.lit("say")))
    assert [r["id"] for r in rl.confident(frame).orderBy("id").collect()] == [5]
    assert lx.RELATION_THRESHOLD == 0.4


TEXTS = [(1, "Acme owns a large factory. Bob said the words!\nIt is. Red cat was here, there, blue."), (2, None), (3, "...")]


def test_both_routes_agree(spark, rows):
    frame = spark.createDataFrame(TEXTS, "article_id long, text string")
    columns = ("article_id", "sent", "subject", "predicate", "object", "confidence")
    direct = rows(rl.relations_of_text(frame), *columns)
    assert direct == rows(rl.relations_of_tokens(rl.annotate(frame)), *columns)
    assert [r[2:5] for r in direct] == [("Acme", "owns", "large"), ("Bob", "said", "words"), ("cat", "was", "blue")]


def test_annotation_columns(spark):
    frame = spark.createDataFrame(TEXTS[:1], "article_id long, text string")
    tokens = rl.annotate(frame).orderBy("i").collect()
    assert [t["i"] for t in tokens] == list(range(len(tokens)))
    first = {t["text"]: (t["pos"], t["dep"], t["lemma"], t["head_i"]) for t in tokens[:5]}
    assert first["owns"] == ("VERB", "ROOT", "own", 1) and first["Acme"] == ("NOUN", "nsubj", "acme", 1)
    assert first["a"][0] == "DET" and first["large"][1] == "dobj"
    assert [t["is_punct"] for t in tokens[:6]] == [False] * 5 + [True]


def test_own_relations_need_no_shuffle(spark):
    frame = spark.createDataFrame(TEXTS, "article_id long, text string")
    for result in (rl.relations_of_text(frame), rl.annotate(frame)):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan


def test_semi_join_on_linked_articles(spark, rows):
    triples = spark.createDataFrame([(1, "a"), (2, "b")], "article_id long, subject string")
    linked = spark.createDataFrame([(2, "x"), (2, "y")], "article_id long, text string")
    assert rows(rl.of_linked_articles(triples, linked), "subject") == [("b",)]
