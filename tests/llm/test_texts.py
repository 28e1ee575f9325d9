"""Quality rules, substring removal, WARC archives and mixing against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest

from newsgraph.llm import mixing, quality, substring, warc
from newsgraph.llm.quality import Condition

from .conftest import SCHEMA, messy_rows


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# -- quality


def brute_counts(text):
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in (text or "").split("\n") if words_of(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_counts(spark, messy, rows):
    rnd = random.Random(4)
    more = [(100 + i, " ".join(rnd.choice("abc") for _ in range(rnd.randrange(40))), *[None] * 11) for i in range(60)]
    frame = messy.unionByName(spark.createDataFrame(more, SCHEMA))
    expected = sorted([(r[0], *brute_counts(r[1])) for r in messy_rows() + more], key=repr)
    assert rows(quality.with_counts(frame.select("doc_id", "text")), "doc_id", *quality.BASE) == expected


def made_up(spark):
    rnd = random.Random(9)
    docs, labels = [], []
    for i in range(400):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8))) for _ in range(120)]
        bad = i % 4 == 0
        if bad and i % 8:
            words = [w + rnd.choice(["###", "$$$"]) for w in words]
        elif bad:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 0 if bad else 1, 0))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"
    )


def test_rules_are_learned(spark):
    docs, labels = made_up(spark)
    for row in quality.verdicts(docs, labels).collect():
        assert row.kept == (row.doc_id % 4 != 0)
        assert not row.base_failed
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(400) if i % 4]


def test_texts_without_words_meet_learned_shares(spark):
    """A text without words has no shares: it fails the base, and no rule divides by its zero words or lines."""
    docs, labels = made_up(spark)
    blank = [(400 + i, text, "en", "s", 0) for i, text in enumerate([None, "", " \n\t "])]
    docs = docs.unionByName(spark.createDataFrame(blank, docs.schema))
    labels = labels.unionByName(spark.createDataFrame([(d, 0, 0) for d, *_ in blank], labels.schema))
    found = {r.doc_id: r for r in quality.verdicts(docs, labels).collect()}
    assert len(found) == 403 and all(found[d].kept == (d % 4 != 0) for d in range(400))
    assert all(found[d].base_failed and not found[d].kept and found[d].rule == 0 for d in (400, 401, 402))
    assert sorted(r.doc_id for r in quality.keep_good(docs, labels).collect()) == [i for i in range(400) if i % 4]
    twice = [(Condition("word_length", True, 2.0), Condition("word_length", False, 3.0)), (Condition("line_words", False, 8.0),)]
    assert quality.with_counts(docs).where("doc_id >= 400").select(quality.rule_number(twice).alias("rule")).distinct().collect() == [(0,)]


def test_rule_order():
    rules = [(Condition("words", True, 64.0),), (Condition("words", True, 32.0), Condition("word_length", False, 3.0))]
    assert [c.sql() for c in rules[1]] == ["n_words >= 32.0D", "word_chars / n_words < 3.0D"]
    assert str(quality.rule_number(rules)).count("CASE WHEN") >= 1


def test_plan_has_no_python(spark, messy, labels):
    plan = quality.verdicts(messy, labels)._jdf.queryExecution().toString() + quality.keep_good(messy, labels)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_messy_verdicts(messy, empty, labels, rows):
    found = rows(quality.verdicts(messy, labels), "doc_id", *quality.BASE, "base_failed")
    expected = []
    for r in messy_rows():
        counts = brute_counts(r[1])
        expected.append((r[0], *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]))
    assert found == sorted(expected, key=repr)
    assert quality.verdicts(empty, labels).count() == 0
    assert quality.verdicts(messy, labels.limit(0)).where("kept").count() == sum(not e[-1] for e in expected)
    assert quality.keep_good(messy, labels).columns == messy.columns


# -- substring


def brute_cut(table):
    low = {}
    for doc, text in table:
        words = words_of(text)
        if doc is not None:
            for i in range(len(words) - 12):
                key = tuple(words[i : i + 13])
                low[key] = min(doc, low.get(key, doc))
    out = []
    for doc, text in table:
        words = words_of(text)
        gone = {j for i in range(len(words) - 12) if doc is not None and low[tuple(words[i : i + 13])] < doc for j in range(i, i + 13)}
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def passages():
    rnd = random.Random(11)
    shared = [" ".join(rnd.choice("pqrstuv") + str(rnd.randrange(30)) for _ in range(n)) for n in (12, 13, 14, 60)]
    rows = []
    for i in range(60):
        parts = [" ".join(f"own{i}x{rnd.randrange(9)}" for _ in range(rnd.randrange(30))) for _ in range(4)]
        for _ in range(rnd.randrange(4)):
            parts.insert(rnd.randrange(len(parts)), rnd.choice(shared))
        rows.append((rnd.randrange(1000), "\n".join(parts)))
    return rows + rows[:3] + [(2000 + i, rows[i][1]) for i in range(5)] + [(3000, "the cat " * 40), (3001, "the cat " * 30)]


@pytest.mark.parametrize("bucket", [4096, 1])
def test_windows(spark, bucket, rows):
    from pyspark.sql import functions as F

    table = passages()
    frame = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    cut = substring.without_repeats(frame, bucket_rows=bucket)
    assert rows(cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256))) == brute_cut(table)


def test_messy_windows(messy, empty, rows):
    assert rows(substring.removals(messy)) == brute_cut([r[:2] for r in messy_rows()])
    assert substring.removals(empty).count() == 0
    kept = substring.without_repeats(messy, keep_untouched=True)
    assert kept.columns == [*messy.columns, "_n_words", "n_removed"]
    texts = {r.doc_id: r.text for r in kept.collect() if r.n_removed == 0 and r.doc_id is not None and r.doc_id != 5}
    assert texts == {r[0]: r[1] for r in messy_rows() if r[0] in texts}


@pytest.mark.parametrize("size", [substring.SEGMENT - 1, substring.SEGMENT, substring.SEGMENT + 1, 2 * substring.SEGMENT])
def test_words_of_about_a_segment_hash_alike_anywhere(size):
    word = b"w" * size
    alone = substring.word_hashes(word)[0][0]
    assert substring.word_hashes(word + b" y")[0][0] == alone
    assert substring.word_hashes(b"x " + word)[0][1] == alone
    assert substring.word_hashes(b"x " + word + b" y " + word)[0][[1, 3]].tolist() == [alone, alone]


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    monkeypatch.setattr(substring, "SEGMENT", 64)
    monkeypatch.setattr(substring, "_tables", [])
    words = ["ab", "x" * 100, "y" * 63, "ab", "z" * 300, "x" * 100, "ab\x00", "é"] * 5
    hashes, firsts = substring.word_hashes(" \n".join(words).encode())
    assert len(hashes) == len(words)
    by_word = {}
    for word, value in zip(words, hashes.tolist(), strict=True):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


# -- WARC


def test_archives(spark, tmp_path, rows):
    big, odd = "p" * 1500, "WARC/1.1\r\n\r\n\r\nWARC-Type: response\r\n\r\n" + "q" * 1200
    html = [(1, "http://a", big), (2, None, big), (9, "http://c\r\nX: y", big), (3, "http://d", None), (4, "u", ""), (5, "u", "small"), (6, "u", "small"),
            (7, "u", odd), (8, "u", odd), (10, "u", "ünïcödé 🙂" * 200), (None, "u", big), (7, "u", odd), (11, "u", "\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in html], "page_id long, url string, html string, payload string, n int").repartition(3)
    found = rows(warc.deduplicated(pages, str(tmp_path / "archive")))
    top = {big: 9, odd: 8}
    expected = []
    for page, _, text in html:
        data = (text or "").encode()
        refers = top.get(text) if len(data) >= 1000 and (page is None or page < top.get(text, -1)) else None
        expected.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    assert found == sorted(expected, key=repr)
    assert warc.deduplicated(pages.limit(0)).count() == 0


def test_record_layout(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "r" * 1000), (2, "http://b", "r" * 1000)], "page_id long, url string, html string")
    warc.write_archives(warc.resolve(pages), str(tmp_path / "w"), "run0", compression="none")
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    seen = []
    while data:  # by declared lengths alone, as any reader would
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n")
        block, data = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]) :]
        assert data.startswith(b"\r\n\r\n")
        data = data[4:]
        seen.append((fields["WARC-Type"], fields["WARC-Target-URI"], block.partition(b"\r\n\r\n")[2].decode(), fields.get("WARC-Refers-To"), fields["WARC-Record-ID"]))
    revisit, response = sorted(seen, key=lambda s: s[1])
    assert (revisit[0], response[0]) == ("revisit", "response")
    assert revisit[3] == response[4] and revisit[2] == "" and response[2] == "r" * 1000


# -- mixing


def draws(seed, key, rate):
    """Copies by plain inversion."""
    import math

    chunks = max(1, math.ceil(rate / 32))
    total = 0
    for j in range(chunks):
        parts = [str(seed), *([] if key is None else [str(key)]), str(j)]
        u = int(hashlib.md5(":".join(parts).encode()).hexdigest()[:13], 16) / 2.0**52
        p = c = math.exp(-rate / chunks)
        k = 0
        while c <= u and k < 120:
            k += 1
            p *= rate / chunks / k
            c += p
        total += k
    return total


def test_mix(spark, messy, empty):
    sizes = Counter(r[3] for r in messy_rows())
    total = sum(sizes.values())
    found = Counter((r.doc_id, r.text, r.source, r._copy) for r in mixing.mix(messy, seed=3).collect())
    expected = Counter()
    for r in messy_rows():
        for k in range(draws(3, r[0], total / (len(sizes) * sizes[r[3]]))):
            expected[(r[0], r[1], r[3], k + 1)] += 1
    assert found == expected
    assert mixing.mix(empty).count() == 0


def test_weights(spark):
    rows = [(i, "hot" if i % 3 else "cold") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    found = Counter(r.source for r in mixing.mix(docs, {"hot": 1.0, "cold": 3.0, "absent": 1.0}, rows=3000).collect())
    assert abs(found["cold"] - 2250) < 220 and abs(found["hot"] - 750) < 120
    assert mixing.mix(docs, {"hot": 1.0}).where("source = 'cold'").count() == 0
    many = mixing.mix(docs.limit(5), {"hot": 1.0, "cold": 1.0}, rows=1000).collect()
    sizes = Counter(s for _, s in rows[:5])
    assert len(many) == sum(draws(17, i, 500 / sizes[s]) for i, s in rows[:5])
    with pytest.raises(ValueError):
        mixing.mix(docs, {"hot": -1.0})


def test_rows_without_a_key_are_spread(spark):
    docs = spark.createDataFrame([(None, f"text {i}", "one") for i in range(400)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs, seed=3)
    parts = [p for p in mixed.rdd.glom().map(len).collect() if p]
    assert sum(parts) == mixed.count() and (len(parts) > 1 or mixed.rdd.getNumPartitions() == 1)
    order = [r.text for r in mixing.mix(docs, {"one": 1.0}, rows=400 * 3).collect()]
    assert order != sorted(order)


def test_dates_are_in_universal_time(spark, tmp_path):
    from datetime import UTC, datetime

    zone = spark.conf.get("spark.sql.session.timeZone")
    pages = spark.createDataFrame([(1, "http://a", "x")], "page_id long, url string, html string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        warc.write_archives(warc.resolve(pages), str(tmp_path / "w"), "run0", compression="none")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    text = "".join(r[0] for r in spark.read.text(str(tmp_path / "w"), wholetext=True).collect())
    written = datetime.strptime(re.search(r"WARC-Date: (\S+)Z", text)[1], "%Y-%m-%dT%H:%M:%S").replace(tzinfo=UTC)
    assert abs((datetime.now(UTC) - written).total_seconds()) < 600
