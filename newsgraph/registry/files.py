"""Queries: sources and sinks. Each writes what Spark derives from the given tables and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.functions import text as tx
from newsgraph.operators import classify as cl
from newsgraph.operators import knowledge as kb
from newsgraph.plans import triples as plan
from newsgraph.registry import found as fd
from newsgraph.registry import graph as gr
from newsgraph.registry import oracle as o
from newsgraph.registry import tables as tb
from newsgraph.registry.inputs import all_turns, articles, labelled_events, longs, table
from newsgraph.scratch import fresh_path
from newsgraph.sources import readers as rd
from newsgraph.sources import sinks as sk


def _excel_like(spark, sf_dir):
    """Documents under the headers of a spreadsheet export."""
    return articles(spark, sf_dir).select("article_id", F.col("text").alias("Text"), F.col("url").alias("Link"))


def read_articles(spark, sf_dir):
    path = fresh_path(spark, "articles") + ".parquet"
    sk.write_table(_excel_like(spark, sf_dir), path)
    return rd.read_articles(spark, path, identity="article_id")


def read_unnumbered_articles(spark, sf_dir):
    """Without an identity column rows are numbered in file order: one file per range of documents, sizes unlike."""
    path = fresh_path(spark, "articles") + ".json"
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("Text"), F.col("source").alias("Link"))
    rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id").drop("doc_id").write.json(path)
    return rd.read_articles(spark, path, schema="Text string, Link string")


def read_sentences(spark, sf_dir):
    path = fresh_path(spark, "sentences") + ".json"
    sk.write_table(all_turns(spark, sf_dir), path, "json")
    return rd.read_sentences(spark, path, schema="article_id long, Sentence string")


def _triples_text(spark, sf_dir):
    """events as header-less tab-separated triples; errors have no predicate."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("a"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("b"), F.col("user_id").cast("string").alias("c"),
    )
    path = fresh_path(spark, "triples") + ".txt"
    rows.write.option("sep", "\t").csv(path)
    return path


def read_triples(spark, sf_dir):
    return rd.read_triples_text(spark, _triples_text(spark, sf_dir))


def read_by_suffix(spark, sf_dir):
    """The same turns through every format; Excel and unknown suffixes are refused."""
    rows, out = all_turns(spark, sf_dir), None
    for fmt, suffix in (("csv", "csv"), ("json", "json"), ("parquet", "parquet"), ("orc", "orc")):
        path = f"{fresh_path(spark, 'by-suffix')}.{suffix}"
        sk.write_table(rows, path, fmt)
        read = rd.read_sentences(spark, path).select("Sentence", F.lit(fmt).alias("format"))
        out = read if out is None else out.union(read)
    lines = rd.read_sentences(spark, _triples_text(spark, sf_dir)).select("Sentence", F.lit("txt").alias("format"))
    refused = 0
    for path in ("sheet.xlsx", "sheet.xls", "notes.doc"):
        try:
            rd.read_sentences(spark, path)
        except ValueError:
            refused += 1
    counts = out.union(lines).groupBy("format").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.char_length("Sentence")).alias("chars")
    )
    return longs(counts.withColumn("refused", F.lit(refused)))


def read_labelled(spark, sf_dir):
    path = fresh_path(spark, "labelled")
    sk.write_table(labelled_events(spark, sf_dir).toDF("id", " Subject", "Relation ", "OBJECT"), path, "csv")
    return rd.read_labelled_triples(spark, path).withColumn("id", F.col("id").cast("long"))


def _split_table(spark, sf_dir):
    return plan.with_small_train(plan.prepare_triples(labelled_events(spark, sf_dir), "id"))


def read_splits(spark, sf_dir):
    path = fresh_path(spark, "splits")
    sk.write_splits(_split_table(spark, sf_dir), path)
    parts = rd.read_splits(spark, path)
    return parts["train_small"].withColumn("part", F.lit("train_small")).union(parts["valid"].withColumn("part", F.lit("valid")))


def write_articles(spark, sf_dir):
    path = fresh_path(spark, "preprocessed")
    rows = articles(spark, sf_dir).withColumn("tokens", tx.clean_tokens(F.col("text")))
    sk.write_articles(rows.select("article_id", "url", "text", "tokens"), path)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    tokens = F.from_json("tokens", "array<string>")
    return longs(back.select(F.col("article_id").cast("long").alias("article_id"), "url", "text", F.size(tokens).alias("n_tokens")))


def write_article_results(spark, sf_dir):
    path = fresh_path(spark, "entity-analysis")
    sk.write_article_results(gr._results(spark, sf_dir), path)
    back = spark.read.schema(gr._results(spark, sf_dir).schema).json(path)
    return longs(back.select("article_id", "article_url", "metadata.*"))


def write_features(spark, sf_dir):
    path = fresh_path(spark, "features")
    sk.write_features(tb.statistical_features(spark, sf_dir), path)
    return spark.read.parquet(path)


def write_whole_features(spark, sf_dir):
    """All 126 columns written and read back."""
    path = fresh_path(spark, "features")
    sk.write_features(tb.whole_table(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return tb.with_component_count(back).withColumn("n_columns", F.lit(len(back.columns) - 1).cast("long"))


def write_relations(spark, sf_dir):
    path = fresh_path(spark, "relations")
    sk.write_relations(gr.kept_relations(spark, sf_dir), path)
    return longs(spark.read.parquet(path))


def write_entities(spark, sf_dir):
    """Entity types only, one folder each."""
    path = fresh_path(spark, "entities")
    entities = kb.entities(gr._linked_arrivals(spark, sf_dir))
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("type"), "props", F.lit("").alias("uri"), "value", F.lit(1).cast("long"), F.lit("attributes"))
    sk.write_entities(entities.union(events), path)
    back = spark.read.parquet(path)
    return back.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum("confidence_counts").alias("mentions"))


def write_graph(spark, sf_dir):
    path = fresh_path(spark, "graph")
    edges = gr.edges(spark, sf_dir)
    sk.write_graph(kb.all_nodes(kb.nodes(gr._linked_arrivals(spark, sf_dir)), edges), edges, path)
    nodes = spark.read.parquet(f"{path}/nodes").select(F.lit("node").alias("part"), F.coalesce("type", F.lit("")).alias("kind"))
    links = spark.read.parquet(f"{path}/edges").select(F.lit("edge").alias("part"), F.col("relation").alias("kind"))
    return nodes.union(links).groupBy("part", "kind").agg(F.count(F.lit(1)).alias("n"))


def write_splits(spark, sf_dir):
    path = fresh_path(spark, "splits")
    sk.write_splits(_split_table(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


def write_model(spark, sf_dir):
    """Predictions of the classifier after saving and loading it."""
    path = fresh_path(spark, "model")
    splits, model = tb._model(spark, sf_dir)
    sk.write_model(model, path)
    return cl.predict(sk.read_model(path), splits.where("split <> 'train'")).select("id", "predicted")


_SENTENCE = "coalesce(\"Sentence\", '')"
_LINE = "coalesce(event_id::VARCHAR || ' ' || CASE WHEN event_type <> 'error' THEN event_type END || ' ' || user_id::VARCHAR, '')"

QUERIES = {
    "src1_articles": (read_articles, o.sql("SELECT article_id, ord, url, text FROM articles")),
    "src1_unnumbered_articles": (read_unnumbered_articles, """
        SELECT row_number() OVER (ORDER BY doc_id) - 1 AS article_id, row_number() OVER (ORDER BY doc_id) - 1 AS ord,
               source AS url, text FROM documents"""),
    "src2_sentences": (read_sentences, o.sql(f"SELECT article_id, {_SENTENCE} AS \"Sentence\" FROM all_turns")),
    "src3_triples_text": (read_triples, f"""
        SELECT event_id::VARCHAR AS "Entity1", CASE WHEN event_type <> 'error' THEN event_type END AS "Predicate",
               user_id::VARCHAR AS "Entity2", {_LINE} AS "Sentence" FROM events"""),
    "src4_by_suffix": (read_by_suffix, o.sql(f"""
        SELECT format, count(*) AS n, sum(length({_SENTENCE}))::BIGINT AS chars, 3::BIGINT AS refused
        FROM all_turns, (VALUES ('csv'), ('json'), ('parquet'), ('orc')) f(format) GROUP BY format
        UNION ALL SELECT 'txt', count(*), sum(length({_LINE}))::BIGINT, 3::BIGINT FROM events""")),
    "src5_labelled_triples": (read_labelled, o.sql("SELECT id, entity1, predicate, entity2 FROM triples")),
    "src6_splits": (read_splits, o.sql("""
        SELECT id, entity1, predicate, entity2, 'train_small' AS part FROM small_train
        UNION ALL SELECT id, entity1, predicate, entity2, split FROM split_triples WHERE split = 'valid'""")),
    "snk1_articles": (write_articles, o.sql(
        f"SELECT article_id, url, text, len({o.clean_list('text')}) AS n_tokens FROM articles")),
    "snk2_article_results": (write_article_results, o.sql(f"""
        SELECT a.article_id, a.url AS article_url, c.* EXCLUDE (article_id)
        FROM articles a JOIN ({gr._COUNTS}) c ON c.article_id = a.article_id""")),
    "snk3_features": (write_features, o.sql(tb._STATISTICS)),
    "snk3_whole_features": (write_whole_features, o.sql(
        f"SELECT *, {lx.SVD_COMPONENTS} AS n_components, 126 AS n_columns FROM ({tb.FEATURE_TABLE})")),
    "snk4_relations": (write_relations, o.sql(gr._ALL_RELATIONS.format("relations"))),
    "snk5_entities": (write_entities, o.sql("""
        SELECT type, count(*) AS n, sum(confidence_counts)::BIGINT AS mentions FROM kb_entities
        WHERE category = 'entities' GROUP BY type""")),
    "snk6_graph": (write_graph, o.sql("""
        SELECT part, kind, count(*) AS n FROM (
            SELECT 'node' AS part, type AS kind FROM kb_nodes UNION ALL SELECT 'node', '' FROM kb_endpoints
            UNION ALL SELECT 'edge', relation FROM kb_edges) GROUP BY part, kind""")),
    "snk7_splits": (write_splits, o.sql("""
        SELECT split, count(*) AS n, sum(id)::BIGINT AS ids FROM (
            SELECT split, id FROM split_triples UNION ALL SELECT 'train_small', id FROM small_train) GROUP BY split""")),
    "snk8_model": (write_model, None),
}
