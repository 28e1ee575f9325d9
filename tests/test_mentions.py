import random
import time

import pytest

from newsgraph import lexicon as lx
from newsgraph.operators import mentions as mn

ATTRIBUTES = [
    (1, "It rose 5% to $3.5 million on January 5, 2024 at 10:30 am."),
    (2, "The 3rd and second runs: 12 km, 7 mentions, 1,200 cases."),
    (3, "Nothing here, 5thhe mayor Juneau."),
    (4, ""), (5, None),
]


def test_attribute_types_in_text_order(spark):
    frame = spark.createDataFrame(ATTRIBUTES, "article_id long, text string")
    got = [tuple(r) for r in mn.attribute_mentions(frame).orderBy("article_id", "pos").select("article_id", "text", "label").collect()]
    assert got == [
        (1, "5%", "PERCENT"), (1, "$3.5 million", "MONEY"), (1, "January 5, 2024", "DATE"), (1, "10:30 am", "TIME"),
        (2, "3rd", "ORDINAL"), (2, "second", "ORDINAL"), (2, "12 km", "QUANTITY"), (2, "7", "CARDINAL"), (2, "1,200", "CARDINAL"),
    ]


def gazetteer(spark):
    return spark.createDataFrame(
        [("new york", "GPE"), ("new york times", "ORG"), ("york", "GPE"), ("times square", "LOC"), ("acme", "ORG"), ("acme", "PERSON")],
        "term string, label string",
    )


def test_longest_then_leftmost(spark):
    frame = spark.createDataFrame(
        [(1, "The New York Times Square"), (2, "Acme in New York, Times"), (3, "new york")], "article_id long, text string")
    got = [tuple(r) for r in mn.entity_mentions(frame, gazetteer(spark)).orderBy("article_id", "pos").select("article_id", "text", "label").collect()]
    assert got == [(1, "New York Times", "ORG"), (2, "Acme", "PERSON"), (2, "New York", "GPE")]


def test_runs_stop_at_punctuation_and_case_is_optional(spark):
    frame = spark.createDataFrame([(1, "new, york new york")], "article_id long, text string")
    got = [r["text"] for r in mn.entity_mentions(frame, gazetteer(spark), capitalised=False).orderBy("pos").collect()]
    assert got == ["york", "new york"]


def test_terms_of_any_length(spark):
    words = spark.createDataFrame([("united states of america", "GPE"), ("the long and winding road to nowhere", "LOC")], "term string, label string")
    frame = spark.createDataFrame([(1, "The United States of America"), (2, "The Long and Winding Road to Nowhere, The long")], "article_id long, text string")
    got = [tuple(r) for r in mn.entity_mentions(frame, words).orderBy("article_id").select("article_id", "words", "text").collect()]
    assert got == [(1, 4, "United States of America"), (2, 7, "The Long and Winding Road to Nowhere")]


def test_a_dropped_hit_drops_nothing(spark):
    words = spark.createDataFrame([(t, "ORG") for t in ("a b c", "c d e", "e f g", "a", "h i j k", "g h i")], "term string, label string")
    frame = spark.createDataFrame([(1, "A B C D E F G"), (2, "G H I J K"), (3, "A B"), (4, "E F G H I J K")], "article_id long, text string")
    got = [tuple(r) for r in mn.entity_mentions(frame, words).orderBy("article_id", "pos").select("article_id", "text").collect()]
    assert got == [(1, "A B C"), (1, "E F G"), (2, "H I J K"), (3, "A"), (4, "E F G"), (4, "H I J K")]


def test_lists_and_groups(spark):
    frame = spark.createDataFrame([(1, "Acme paid 5% and 7% to Acme"), (2, "nothing")], "article_id long, text string")
    found = mn.all_mentions(frame, gazetteer(spark))
    lists = {r["article_id"]: [m["text"] for m in r["mentions"]] for r in mn.mention_lists(frame, found).collect()}
    assert lists == {1: ["Acme", "5%", "7%", "Acme"], 2: []}
    groups = {r["article_id"]: r["groups"] for r in mn.mentions_by_label(found).collect()}
    assert groups == {1: {"PERSON": ["Acme", "Acme"], "PERCENT": ["5%", "7%"]}}
    back = mn.explode_mentions(mn.mention_lists(frame, found))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, found.collect()))


def test_no_row_carries_its_article(spark):
    """A run of pieces is cut before the pieces are exploded, so a long text stays linear."""
    frame = spark.createDataFrame([(1, "Word " * 60_000)], "article_id long, text string")
    assert mn.ngrams(frame).count() == 60_000 * 3 - 3


def brute_taken(hits):
    order = {name: i for i, name in enumerate(lx.ENTITY_TYPES + lx.ATTRIBUTE_TYPES)}
    taken = []
    for pos, words, text, label in sorted(hits, key=lambda h: (-h[1], h[0], order[h[3]])):
        if all(pos + words <= t[0] or t[0] + t[1] <= pos for t in taken):
            taken.append((pos, words, text, label))
    return sorted(taken)


@pytest.mark.parametrize("small", [0, 24])
def test_overlaps_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(mn, "SMALL_ISLAND", small)
    rnd = random.Random(7)
    articles = {}
    for a in range(12):
        hits = {(rnd.randrange(0, 900 if a % 2 else 60), rnd.choice([1, 1, 2, 3, 7, 300 if a == 3 else 4]), rnd.choice(["PERSON", "ORG", "GPE"])) for _ in range(150)}
        articles[a] = [(p, w, f"{p}-{w}", label) for p, w, label in hits]
    rows = [(a, *h) for a, hits in articles.items() for h in hits]
    frame = spark.createDataFrame(rows, "article_id long, pos int, words int, text string, label string").repartition(3)
    found = {}
    for r in mn.without_overlaps(frame).collect():
        found.setdefault(r["article_id"], []).append((r["pos"], r["words"], r["text"], r["label"]))
    assert {a: sorted(h) for a, h in found.items()} == {a: brute_taken(h) for a, h in articles.items()}


def test_a_long_chain_of_hits_takes_seconds(spark):
    chain = spark.range(3_000).selectExpr("1L article_id", "cast(id as int) pos", "2 words", "cast(id as string) text", "'ORG' label")
    start = time.time()
    taken = mn.without_overlaps(chain)
    assert taken.agg({"pos": "sum", "words": "count"}).first()[0:2] is not None
    assert taken.count() == 1_500 and taken.where("pos % 2 = 1").count() == 0
    assert time.time() - start < 120
