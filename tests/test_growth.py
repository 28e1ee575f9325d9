"""What the findings of the third round asked for."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.functions import text as tx
from newsgraph.operators import features as ft
from newsgraph.operators import mentions as mn
from newsgraph.operators import relations as rl
from newsgraph.operators import scale, svd
from newsgraph.operators import tfidf as ti
from newsgraph.registry import tables as tb
from newsgraph.scratch import forget, materialise, shared_dir


def documents(spark, folder, texts):
    rows = [(i, t, "en", "web", len(t)) for i, t in texts]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def plan(frame, part="optimizedPlan"):
    return getattr(frame._jdf.queryExecution(), part)().toString()


def test_a_staged_table_frees_its_shuffles(spark):
    """shuffle files of steps that are written down stayed beside them until the driver collected garbage."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffle_files():
        return {name for folder in folders for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}

    before = shuffle_files()
    table = materialise(spark.range(10_000).repartition(7).groupBy((F.col("id") % 13).alias("k")).count(), "freed")
    assert not shuffle_files() - before
    assert table.count() == 13
    file = table.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(file)
    forget(table)
    assert not os.path.exists(file)


def _sparse(spark, n, m, seed=11):
    rnd = np.random.default_rng(seed)
    matrix = np.where(rnd.random((n, m)) < 0.4, rnd.random((n, m)), 0.0)
    df = (matrix > 0).sum(axis=0)
    rows = [(int(i), f"t{j}", int(df[j]), float(matrix[i, j])) for i in range(n) for j in range(m) if matrix[i, j]]
    return matrix, spark.createDataFrame(rows, "article_id long, term string, df long, w double")


def test_the_svd_moves_few_columns_at_once_and_keeps_one_copy(spark, monkeypatch):
    """F2-F4: every pass sent all columns of all terms of all blocks, beside three copies of the entries."""
    monkeypatch.setattr(svd, "GRAM_ROWS", -1)
    monkeypatch.setattr(svd, "SLICE_ENTRIES", 50, raising=False)
    monkeypatch.setattr(svd, "MOVED_BYTES", 30_000, raising=False)
    matrix, weights = _sparse(spark, 40, 25)
    asked, apply = [], svd._apply
    monkeypatch.setattr(svd, "_apply", lambda entries, places, thin, right, *rest, **more: asked.append((places, right.shape[1])) or apply(entries, places, thin, right, *rest, **more))
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    scores, sigma = svd.truncated_svd(weights, k=15, iterations=1)
    found = np.array([r["components"] for r in scores.orderBy("article_id").collect()])
    u, s, _ = np.linalg.svd(matrix)
    assert np.allclose(sigma, s[:15]) and np.allclose(np.abs(found), np.abs(u[:, :15] * s[:15]), atol=1e-6)
    assert len(asked) > 2 and all(16 * places * columns <= 30_000 for places, columns in asked)
    assert {name.split("_")[0] + name.split("_")[1][:4] if "_" in name else name for name in set(os.listdir(folder)) - before} == {"svdthin"}


def test_tables_behind_the_weights_go_after_their_last_use(spark, tmp_path):
    path = str(tmp_path / "texts")
    spark.createDataFrame([(i, f"red car {i % 7} blue boat") for i in range(30)], "article_id long, text string").write.parquet(path)
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    scores, _ = svd.truncated_svd(ti.tfidf(spark.read.parquet(path)), k=3, last_use=True)
    assert scores.count() == 30 and spark.read.parquet(path).count() == 30
    assert not {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before} & {"term-counts", "idf"}


@pytest.mark.parametrize("blocks", [6, 8, 12])
def test_blocks_have_buckets_of_their_own(spark, blocks):
    rows = spark.range(2000).select(F.col("id").alias("article_id")).select(svd._blocks(spark, blocks).alias("block"))
    assert rows.distinct().select(F.pmod(F.hash("block"), F.lit(blocks))).distinct().count() == blocks


def test_passes_of_the_svd_leave_no_tables(spark, monkeypatch):
    """every pass left its thin matrix and its sums."""
    monkeypatch.setattr(svd, "GRAM_ROWS", -1)
    rnd = np.random.default_rng(3)
    matrix = np.where(rnd.random((40, 25)) < 0.4, rnd.random((40, 25)), 0.0)
    df = (matrix > 0).sum(axis=0)
    rows = [(int(i), f"t{j}", int(df[j]), float(matrix[i, j])) for i in range(40) for j in range(25) if matrix[i, j]]
    weights = spark.createDataFrame(rows, "article_id long, term string, df long, w double")
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    scores, sigma = svd.truncated_svd(weights, k=5)
    assert scores.count() == 40
    assert np.allclose(sigma, np.linalg.svd(matrix, compute_uv=False)[:5])
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert not left & {"svd-start", "svd-sums", *[f"svd-pass{i}" for i in range(9)]}


def test_split_of_document_triples_reads_the_documents_once(spark, tmp_path):
    """the fallback split cut the texts anew for each of its counts and joins."""
    folder = documents(spark, tmp_path, [(i, f"Anna owns boats. Berta owns boats. Carl owns ships {i}.") for i in range(6)])
    split = tb.fallback_split(spark, folder)
    assert "documents.parquet" not in plan(split, "executedPlan")
    assert sorted(r["split"] for r in split.collect()).count("test") >= 1
    assert "documents.parquet" not in plan(tb.rare_dropped(spark, folder), "executedPlan")


def test_statistics_of_tokens_derive_the_tokens_once(spark):
    """the token table was derived a second time for the number of different words."""
    docs = spark.createDataFrame([(1, "A cat saw a Cat. The 7 cats!"), (2, ""), (3, None)], "article_id long, text string")
    tokens = rl.annotate(docs)
    found = ft.statistical_features_of_tokens(docs, tokens)
    assert plan(found).lower().count("posexplode") == 1
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, ft.statistical_features(docs).collect()))
    # a null text is one more word, as it was
    given = spark.createDataFrame(
        [(1, 0, 0, "a", "DET", False, False), (1, 0, 1, None, "NOUN", False, False), (1, 1, 2, "A", "DET", False, False), (1, 1, 3, None, "NOUN", False, False)],
        "article_id long, sent int, i int, text string, pos string, is_stop boolean, is_punct boolean")
    assert ft.statistical_features_of_tokens(docs, given).where("article_id = 1").first()["unique_words"] == 2


def test_sentences_are_trimmed_at_their_ends_only(spark):
    """a second pattern went over all blanks of every text."""
    blanks = [chr(c) for c in (*range(1, 0x3100), 0xFEFF)]
    frame = spark.createDataFrame([(i, f"{c}{c}a{c}b{c}") for i, c in enumerate(blanks)], "id long, text string")
    found = frame.select("id", tx.sentences(F.col("text")).alias("s"))
    assert "regexp_replace" not in plan(found)
    by_pattern = F.filter(F.transform(
        F.regexp_extract_all("text", F.lit(lx.SENTENCE), F.lit(0)), lambda s: F.regexp_replace(s, rf"^[{lx.SPACE}]+|[{lx.SPACE}]+$", "")), lambda s: s != "")
    assert frame.where(~tx.sentences(F.col("text")).eqNullSafe(by_pattern)).count() == 0


@pytest.mark.parametrize("capitalised", [True, False])
def test_starts_equal_the_patterns(spark, capitalised):
    pieces = ["seven", "Seven", "sEVEN", "éa", "{", "zz", "a", "`", "_x", "٣", "$5", "€", "ǅo", "Ünder", "ßa", "5th", "", "\U0001d4d0x"]
    frame = spark.createDataFrame([(p,) for p in pieces], "p string")
    expected = F.col("p").rlike(mn._first_letter(capitalised)) | mn._may_be_attribute(F.col("p"))
    assert frame.where(~mn._may_start(F.col("p"), capitalised).eqNullSafe(expected)).count() == 0


def test_a_split_is_dealt_to_several_parts(spark, monkeypatch):
    """with many splits a part was as large as a split, so the longest task grew with the table."""
    monkeypatch.setattr(scale, "parts", lambda _: 2)
    assert scale.spread(spark.range(100, numPartitions=10), "id").rdd.getNumPartitions() == 40
    monkeypatch.setattr(scale, "MOST_PARTS", 15)
    assert scale.spread(spark.range(100, numPartitions=10), "id").rdd.getNumPartitions() == 15
    assert scale.spread(spark.range(100, numPartitions=20), "id").rdd.getNumPartitions() == 20


def test_products_only_of_groups_with_a_common_term(spark, tmp_path):
    """The SQL gives no row for groups without a common term; the query gave them as 0."""
    folder = documents(spark, tmp_path, [(0, "red boat"), (41, "red house"), (79, "tall tree"), (80, "old boat"), (-3, "tall ship")])
    pairs = {(r["a"], r["b"]) for r in tb.svd_products(spark, folder).collect()}
    assert pairs == {(0, 0), (41, 41), (79, 79), (-3, -3), (0, 41), (-3, 79)}
