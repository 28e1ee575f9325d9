"""Language identification and toxicity: held-out accuracy, the models' sums, and defined results for odd rows."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from newsgraph.llm import charcodes, langid, toxicity

from .conftest import messy_rows

SYLLABLES = {"aa": "ka lo mi nu re sta vo", "bb": "zwi krä tö bün schl ert ung", "cc": "que ll ñe ció dad el os"}


def corpus(count, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(count):
        lang = sorted(SYLLABLES)[i % 3]
        parts = SYLLABLES[lang].split()
        words = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 4))) for _ in range(rnd.randrange(5, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_hash_array():
    rnd = np.random.default_rng(2)
    keys = np.unique(rnd.integers(0, 1 << 63, 5000, dtype=np.uint64))
    table = charcodes.HashArray(keys)
    asked = np.concatenate([keys[::3], rnd.integers(0, 1 << 63, 500, dtype=np.uint64), keys[:1]])
    place = {int(k): i for i, k in enumerate(keys)}
    assert table.rows(asked).tolist() == [place.get(int(k), -1) for k in asked]
    assert charcodes.HashArray(keys[:0]).rows(asked).tolist() == [-1] * len(asked)


def test_counters(monkeypatch):
    monkeypatch.setattr(charcodes, "MERGE_KEYS", 50)
    monkeypatch.setattr(charcodes, "FULL_KEYS", 30)
    rnd, counters, found, truth = np.random.default_rng(4), charcodes.Counters(), Counter(), Counter()

    def take():
        for kind, keys, numbers in counters.empty():
            found.update({(kind, int(k)): int(n) for k, n in zip(keys, numbers, strict=True)})
        assert not counters.held and counters.size == 0

    for i in range(60):
        keys = rnd.integers(0, 60 if i < 30 else 20, 25, dtype=np.uint64)
        truth.update(("ab"[i % 2], int(k)) for k in keys)
        if counters.add("ab"[i % 2], keys):
            take()
    take()
    assert found == truth


def test_folding():
    text = lambda codes: "".join(chr(c) for c in codes)
    assert text(charcodes.folded("  Ab,, ÇD1 ", 2)) == "\x01\x01ab çd "
    assert text(charcodes.folded("", 1)) == "\x01 "
    assert text(charcodes.folded("9🙂9", 1)) == "\x01 "
    assert charcodes.has_letter("1 é") and not charcodes.has_letter("1 🙂")


def brute_model(texts):
    """Interpolated Kneser-Ney of order four, gram by gram; probability of a gram's last code given the others."""
    grams = {4: Counter(), 3: Counter(), 2: Counter(), 1: Counter()}
    for t in texts:
        codes = tuple(charcodes.folded(t, 3).tolist())
        grams[4].update(codes[i : i + 4] for i in range(len(codes) - 3))
    for order in (3, 2, 1):
        grams[order].update(g[1:] for g in grams[order + 1])
    discount, totals = {}, {}
    for order, table in grams.items():
        one, two = sum(n == 1 for n in table.values()), sum(n == 2 for n in table.values())
        discount[order] = min(max(one / (one + 2 * two) if two else 0.5, 0.05), 0.95)
        totals[order] = defaultdict(lambda: [0, 0])
        for g, n in table.items():
            totals[order][g[:-1]][0] += n
            totals[order][g[:-1]][1] += 1

    def probability(gram):
        if not gram:
            return 1 / 0x10000
        order = len(gram)
        total, kinds = totals[order].get(gram[:-1], (0, 0))
        lower = probability(gram[1:])
        if not total:
            return lower
        d = discount[order]
        return max(grams[order].get(gram, 0) - d, 0) / total + d * kinds / total * lower

    return grams[4], probability


def test_model_equals_definition(spark):
    rows = [(t, lang) for _, t, lang in corpus(60, 1)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    scorer = langid.Scorer(model)
    assert model.names == sorted(SYLLABLES)
    asked = [t for t, _ in rows[:6]] + ["xyz kalo überall ñe", "q"]
    for number, name in enumerate(model.names):
        _, probability = brute_model([t for t, lang in rows if lang == name])
        for text in asked:
            codes = tuple(charcodes.folded(text, 3).tolist())
            expected = [np.log(probability(codes[i : i + 4])) for i in range(len(codes) - 3)]
            keys = langid._keys(charcodes.folded(text, 3))
            assert np.allclose(scorer.logs(keys)[:, number], expected, atol=1e-4)
            assert np.isclose(scorer.entropies([text, "zz"])[0][0, number], -np.mean(expected), atol=1e-4)


@pytest.mark.parametrize("numbers", [3000, 30, 0])
def test_a_model_too_large_to_broadcast_gives_the_same(spark, numbers):
    rows = corpus(150, 4) + [(1000, None, "aa"), (1001, "", None), (1002, "123 !?", "bb"), (None, "kalo minu", "aa"), (1003, "X" * 30, None), (0, "日本 qx", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    whole, far = (
        sorted((r.doc_id or -1, r.lang_pred, round(r.score, 4), r.entropy or 0.0, r.rejected) for r in langid.languages(docs, most, numbers).collect())
        for most in (1_000_000, 5)
    )
    assert [r[:3] for r in whole] == [r[:3] for r in far]
    assert np.allclose([r[3] for r in whole], [r[3] for r in far], atol=1e-4)


def test_a_small_language_beside_a_huge_one(spark):
    rnd = random.Random(3)
    parts = "ka lo mi nu re sta vo".split()
    text = lambda order, n: " ".join("".join(order(rnd.choice(parts), rnd.choice(parts))) for _ in range(n))
    near, far = (lambda a, b: a + b), (lambda a, b: a + "x" + b)
    rows = [(i, text(near, 60), "huge") for i in range(400)] + [(i, text(far, 60), "small") for i in range(400, 410)]
    rows += [(i, text(far, 12), None) for i in range(1000, 1020)]
    found = {r.doc_id: r.lang_pred for r in langid.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 5, 30).collect()}
    assert all(found[i] == "small" for i in range(1000, 1020)) and found[0] == "huge"


def test_languages(spark, empty):
    rows = corpus(300, 4) + [(1000, None, "aa"), (1001, "", None), (1002, "123 !?", "bb"), (None, "kalo minu", "aa"), (1003, "X" * 30, None), (0, "kalo", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = langid.languages(docs).collect()
    assert len(found) == len(rows)
    truth = {r[0]: r[2] for r in rows[:300]}
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in SYLLABLES
    hits = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out and r.doc_id in truth]
    assert len(hits) > 40 and all(hits)
    assert langid.languages(empty).count() == 0


def test_languages_without_training(messy):
    from pyspark.sql import functions as F

    found = langid.languages(messy.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in found} == {"und"} and len(found) == len(messy_rows())


def toxic_corpus(count, seed):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(count):
        words = ["".join(rnd.choice("ka lo mi nu re sta vo".split()) for _ in range(rnd.randrange(1, 4))) for _ in range(rnd.randrange(8, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                words.insert(rnd.randrange(len(words)), rnd.choice(["grumbert", "grumbolo", "fizzwark", "fizzwarkum"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity(spark, messy, empty, labels):
    docs, marks = toxic_corpus(1200, 6)
    frame = spark.createDataFrame(docs + [(5000, None), (5001, ""), (None, "grumbert"), (5002, "???")], "doc_id long, text string").repartition(4)
    known = spark.createDataFrame(marks + [(5001, None), (None, 1)], "doc_id long, toxic int")
    found = toxicity.scores(frame, known).collect()
    truth = dict(marks)
    assert len(found) == 1204
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id in (5000, 5001, 5002):
            assert r.predicted == 0
    unseen = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in unseen) >= 0.97 * len(unseen)
    assert toxicity.scores(messy, labels).count() == len(messy_rows())
    assert toxicity.scores(messy, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.scores(empty, labels).count() == 0


def test_held_out_labels_are_not_read(spark):
    docs, marks = toxic_corpus(300, 7)
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    turned = [(i, 1 - t if out(i) else t) for i, t in marks]
    a, b = ({r.doc_id: r.score for r in toxicity.scores(frame, spark.createDataFrame(m, "doc_id long, toxic int")).collect()} for m in (marks, turned))
    assert a == pytest.approx(b)


def test_toxic_expressions_beyond_the_broadcast_tier_count(spark):
    docs, marks = toxic_corpus(300, 8)
    docs += docs[:40] + [(9000, None), (9001, "")]
    frame, known = spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(marks, "doc_id long, toxic int")
    everything, small, none = (sorted(tuple(r) for r in toxicity.scores(frame, known, most=most).collect()) for most in (1_000_000, 300, 0))
    assert len(everything) == len(docs) and len({r[2] for r in everything}) > 100
    for found in (small, none):
        assert [r[:2] for r in found] == [r[:2] for r in everything]
        assert np.allclose([r[2:] for r in found], [r[2:] for r in everything], atol=1e-5)


def brute_ratio(rows):
    """ln P(toxic) - ln P(ordinary) of a run, gram by gram, over lower orders that both classes share."""
    size = toxicity.ORDER
    code = lambda t: tuple(int(c) for c in charcodes.folded(t, size - 1))
    own = [Counter(), Counter()]
    for text, toxic, _ in rows:
        codes = code(text)
        own[toxic].update(codes[i : i + size] for i in range(len(codes) - size + 1))
    lower = {size - 1: Counter(g[1:] for g in own[0] | own[1])}
    for order in range(size - 2, 0, -1):
        lower[order] = Counter(g[1:] for g in lower[order + 1])

    def discount(table):
        one, two = sum(n == 1 for n in table.values()), sum(n == 2 for n in table.values())
        return min(max(one / (one + 2 * two) if one and two else 0.5, 0.05), 0.95)

    def sums(table):
        out = defaultdict(lambda: [0, 0])
        for g, n in table.items():
            out[g[:-1]][0] += n
            out[g[:-1]][1] += 1
        return out

    discounts, totals = {k: discount(t) for k, t in lower.items()}, {k: sums(t) for k, t in lower.items()}
    own_discount, own_totals = [discount(t) for t in own], [sums(t) for t in own]

    def shared(gram):
        if not gram:
            return 1 / (1 << toxicity.BITS)
        order = len(gram)
        total, kinds = totals[order].get(gram[:-1], (0, 0))
        d = discounts[order]
        return max(lower[order].get(gram, 0) - d, 0) / total + d * kinds / total * shared(gram[1:]) if total else shared(gram[1:])

    def probability(gram, toxic):
        total, kinds = own_totals[toxic].get(gram[:-1], (0, 0))
        strength, d = toxicity.STRENGTH, own_discount[toxic]
        return (max(own[toxic].get(gram, 0) - d, 0) + (d * kinds + strength) * shared(gram[1:])) / (total + strength)

    def ratios(text):
        codes = code(text)
        return [np.log(probability(codes[i : i + size], 1) / probability(codes[i : i + size], 0)) for i in range(len(codes) - size + 1)]

    return ratios


def test_class_models_equal_definition(spark):
    docs, marks = toxic_corpus(60, 9)
    rows = [(t, m, i % 3 == 0) for i, ((_, t), (_, m)) in enumerate(zip(docs, marks, strict=True))] + [("qwxyzj é", 1, False)]
    counts = toxicity.gram_counts(spark.createDataFrame(rows, "text string, toxic int, for_curve boolean").repartition(3))
    model = toxicity.train(counts.select("gram", "t", "o"))
    ratios, scorer = brute_ratio(rows), toxicity.Scorer(model.keys, model.values)
    for text in [*[t for t, _, _ in rows[:12]], "qwxyzj", "never seen before", "kaloqwx", "", "grumbert"]:
        assert np.allclose(scorer.differences(toxicity._keys(text)), ratios(text), atol=1e-4)
    assert scorer.differences(toxicity._keys("qwxyzj")).mean() > 0.1  # seen once
    assert abs(scorer.differences(toxicity._keys("ββγγδδεε"))[8:]).max() < 1e-6  # no context of it was seen


def test_curve(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(800):
        x = [1.0, *[rnd.gauss(0, 1) for _ in range(toxicity.FEATURES - 1)]]
        rows.append((x, int(rnd.random() < 1 / (1 + np.exp(-(-1 + 2 * x[1] - x[2]))))))
    found = toxicity.curve(spark.createDataFrame(rows, "x array<double>, toxic int"))
    assert abs(found[0] + 1) < 0.4 and abs(found[1] - 2) < 0.5 and abs(found[2] + 1) < 0.4 and abs(found[3:]).max() < 0.4
    assert np.allclose(toxicity.curve(spark.createDataFrame([], "x array<double>, toxic int")), toxicity.PRIOR)
