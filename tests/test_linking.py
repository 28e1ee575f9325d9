import pytest
from pyspark.sql import functions as F

from newsgraph.functions.similarity import levenshtein_ratio, matching_ratio
from newsgraph.operators import linking as ln

MENTIONS = [(1, 0, "Paris", "GPE"), (1, 1, "paris", "GPE"), (1, 2, "Nowhere", "GPE"), (2, 0, "Paris", "PERSON"),
            (2, 1, "Rome", "GPE"), (2, 2, "Bern", "GPE"), (3, 0, "Oslo", "GPE"), (3, 1, "Bonn", "GPE")]
CATALOGUE = [("Paris", "Q2", "0.9"), ("paris", "Q1", "0.9"), ("Paris", "Q3", None), ("Rome", "Q4", "0.4"),
             ("Bern ", "Q5", None), ("Oslo", None, "0.9"), ("Bonn", "Q6", "many")]


@pytest.fixture
def mentions(spark):
    return spark.createDataFrame(MENTIONS, "article_id long, pos int, text string, label string")


@pytest.fixture
def catalogue(spark):
    return spark.createDataFrame(CATALOGUE, "label string, item string, score string")


def test_links(mentions, catalogue):
    got = {r["text"]: (r["n"], r["uri"], round(r["confidence"], 4)) for r in ln.link_texts(mentions, catalogue).collect()}
    assert got == {
        "Paris": (2, "Q1", 0.9), "paris": (1, "Q1", 0.9), "Rome": (1, "Q4", 0.4), "Bern": (1, "Q5", 0.8889),
        "Oslo": (1, "", 0.1), "Bonn": (1, "", 0.1),
    }


@pytest.mark.parametrize("hot_rows", [10_000_000, 1])
def test_threshold_drops_and_salting_changes_nothing(mentions, catalogue, rows, hot_rows):
    got = rows(ln.link_mentions(mentions, catalogue, hot_rows=hot_rows), "article_id", "pos", "type", "uri")
    assert got == [(1, 0, "GPE", "Q1"), (1, 1, "GPE", "Q1"), (2, 0, "PERSON", "Q1"), (2, 2, "GPE", "Q5")]


def test_threshold_is_inclusive(mentions, catalogue):
    assert ln.link_mentions(mentions, catalogue, threshold=0.4).where("text = 'Rome'").count() == 1


@pytest.mark.parametrize("hot_rows", [10_000_000, 1])
def test_ranking_and_misses(mentions, catalogue, rows, hot_rows):
    top = rows(ln.top_candidates(mentions, catalogue, 2).where("text = 'Paris'"), "rank", "item")
    assert top == [(1, "Q1"), (2, "Q2")]
    full = rows(ln.ordered_candidates(mentions, catalogue, hot_rows).where("text = 'Paris'"), "rank", "item")
    pairs = rows(ln.candidates_for(mentions, catalogue, hot_rows).where("text = 'paris'"), "item")
    assert pairs == [("Q1",), ("Q2",), ("Q3",)]
    assert full == [(1, "Q1"), (2, "Q2"), (3, "Q3")]
    assert rows(ln.unlinked_texts(mentions, catalogue)) == [("Nowhere", 1)]


# left, right, twice the matched characters, all characters
PAIRS = [
    ("Paris", "paris ", 10, 11), ("abcd", "bcde", 6, 8), ("", "", 1, 1), ("", "a", 0, 1), ("New York", "york new", 8, 16),
    ("a     a     ", "     a     a", 22, 24), ("private thread", "private volatile thread", 28, 37), ("abxcd", "abcd", 8, 9),
    ("tide", "diet", 2, 8), ("diet", "tide", 4, 8), ("x" * 250, "x" * 249 + "y", 498, 500),
    # from 200 characters on a frequent character of the second string begins no block, so only the rare one and what
    # touches it match
    ("ab", "a" * 100 + "b" + "c" * 99, 4, 202), ("ca", "a" * 100 + "b" + "c" * 99, 0, 202),
]


def test_matching_ratio(spark):
    frame = spark.createDataFrame([(i, p[0], p[1]) for i, p in enumerate(PAIRS)] + [(99, None, "a"), (98, "a", None)], "i int, a string, b string")
    ratios = frame.select("i", matching_ratio(F.col("a"), F.col("b")).alias("r"))
    got = {r["i"]: r["r"] for r in ratios.collect()}
    assert got.pop(99) is None and got.pop(98) is None
    assert got == {i: pytest.approx(twice / every) for i, (_, _, twice, every) in enumerate(PAIRS)}
    assert "Python" not in ratios._jdf.queryExecution().toString() and "Arrow" not in ratios._jdf.queryExecution().toString()


def test_edit_ratio(spark):
    frame = spark.createDataFrame([(0, "abcd", "bcde"), (1, "", "")], "i int, a string, b string").orderBy("i")
    assert [r[0] for r in frame.select(levenshtein_ratio(F.col("a"), F.col("b"))).collect()] == [pytest.approx(0.5), 1.0]


def grams(text):
    padded = f"  {text} "
    return {padded[i:i + 3] for i in range(len(text) + 1)}


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.6, 0.8, 1.0])
@pytest.mark.parametrize("hot_block", [10_000, 2])
def test_fuzzy_join_equals_brute_force(spark, rows, threshold, hot_block):
    texts = ["new york", "new yorc", "york", "paris", "pariss", "parish", "a", "ab", "bonn", "bon", "new york city", "newyork"]
    labels = ["new york", "york city", "paris", "par", "a", "bonn", "lisbon", "new", "parishes", "ny"]
    mentions = spark.createDataFrame([(t.upper(),) for t in texts], "text string")
    catalogue = spark.createDataFrame([(x,) for x in labels], "label string")
    got = rows(ln.fuzzy_candidates(mentions, catalogue, threshold, hot_block), "text", "label")
    expected = sorted(
        ((t, x) for t in texts for x in labels if len(grams(t) & grams(x)) >= threshold * len(grams(t) | grams(x)) - 1e-12), key=repr)
    assert got == expected


def test_links_by_search(spark):
    labels = [("new yorkk", "Q1", 0.9), ("new yorkers", "Q2", 0.8), ("pariss", "Q3", None), ("parish", "Q4", 0.7), ("rome", "Q5", 0.3),
              ("romer", "Q6", 0.9), ("osloo", None, 0.9), ("bonnn", "Q7", None), ("aaaa", "Q8", 0.6), ("aaaaaa", "Q9", 0.6)]
    mentions = spark.createDataFrame([(1, 0, t, "GPE") for t in ["New York", "Paris", "Rome", "Oslo", "Bonn", "Zzz", "aaaaa"]],
                                     "article_id long, pos int, text string, label string")
    catalogue = spark.createDataFrame(labels, "label string, item string, score double")
    got = {r["text"]: (r["label"], r["uri"], round(r["confidence"], 4)) for r in ln.linked_texts(mentions, catalogue, fuzzy=0.5).collect()}
    assert got == {
        "New York": ("new yorkk", "Q1", 0.9), "Paris": ("parish", "Q4", 0.7), "Rome": ("rome", "Q5", 0.3), "Oslo": ("osloo", "", 0.1),
        "Bonn": ("bonnn", "Q7", 0.8889), "aaaaa": ("aaaa", "Q8", 0.6),
    }
    linked = ln.link_mentions(mentions, catalogue, fuzzy=0.5)
    assert sorted(r["uri"] for r in linked.collect()) == ["Q1", "Q4", "Q7", "Q8"]
    plan = linked._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_search_equals_brute_force_on_random_words(spark, rows):
    import random
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abc ") for _ in range(rnd.randrange(1, 12))).strip() or "a"
    texts, labels = {word() for _ in range(150)}, {word() for _ in range(200)}
    mentions = spark.createDataFrame([(t,) for t in texts], "text string")
    catalogue = spark.createDataFrame([(x,) for x in labels], "label string")
    for threshold in (0.4, 0.7):
        sim = {(t, x): len(grams(t) & grams(x)) / len(grams(t) | grams(x)) for t in texts for x in labels}
        got = rows(ln.fuzzy_candidates(mentions, catalogue, threshold, 20), "text", "label")
        assert got == sorted((p for p, s in sim.items() if s >= threshold - 1e-12), key=repr)
        near = {r["key"]: r["label_key"] for r in ln.nearest_labels(mentions, catalogue, threshold).collect()}
        best = {}
        for t in texts:
            found = [(-sim[t, x], t != x, abs(len(t) - len(x)), x) for x in labels if sim[t, x] >= threshold - 1e-12]
            if found:
                best[t] = min(found)[3]
        assert near == best
