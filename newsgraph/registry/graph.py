"""Queries: annotations, relations, knowledge base, whole article runs."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from newsgraph.operators import knowledge as kb
from newsgraph.operators import mentions as mn
from newsgraph.operators import relations as rl
from newsgraph.operators.scale import parts
from newsgraph.plans import articles as plan
from newsgraph.registry import found as fd
from newsgraph.registry import oracle as o
from newsgraph.registry.inputs import articles, catalogue, gazetteer, longs, table
from newsgraph.scratch import fresh_path, materialise
from newsgraph.streaming import kb as stream


def _rounded(df, column="confidence"):
    return longs(df.withColumn(column, F.round(column, 6)))


def token_table(spark, sf_dir):
    return longs(rl.annotate(articles(spark, sf_dir)))


def relations_of_text(spark, sf_dir):
    """Unrounded: the confidence must agree to the last bit."""
    return longs(rl.relations_of_text(articles(spark, sf_dir)))


def relations_of_tokens(spark, sf_dir):
    rows = rl.relations_of_tokens(rl.annotate(articles(spark, sf_dir)))
    return longs(rows.drop("pos"))


def subjects(spark, sf_dir):
    rows = rl.relations_of_text(articles(spark, sf_dir))
    return rows.groupBy("subject").agg(F.count(F.lit(1)).alias("n"))


def objects(spark, sf_dir):
    rows = rl.relations_of_text(articles(spark, sf_dir))
    return rows.groupBy("object").agg(F.count(F.lit(1)).alias("n"))


def confidence_levels(spark, sf_dir):
    rows = rl.relations_of_text(articles(spark, sf_dir))
    return rows.groupBy("predicate", "confidence").agg(F.count(F.lit(1)).alias("n"))


def confident_relations(spark, sf_dir):
    return longs(rl.confident(rl.relations_of_text(articles(spark, sf_dir))))


def _kept(spark, sf_dir):
    rows = rl.confident(rl.relations_of_text(articles(spark, sf_dir)))
    return rl.of_linked_articles(rows, fd.linked(spark, sf_dir))


@lru_cache(maxsize=8)
def kept_relations(spark, sf_dir):
    """Confident relations of the articles with a linked entity, staged once per session."""
    return materialise(_kept(spark, sf_dir), "relations")


def linked_article_relations(spark, sf_dir):
    return longs(_kept(spark, sf_dir))


def plain_relations(spark, sf_dir):
    rows = rl.without_confidence(rl.relations_of_text(articles(spark, sf_dir)))
    return longs(rows.select("article_id", "sent", "subject", "predicate", "object", F.coalesce("confidence", F.lit(0.5)).alias("confidence")))


def _linked_arrivals(spark, sf_dir):
    return kb.with_arrival(fd.linked(spark, sf_dir), articles(spark, sf_dir))


def _relation_arrivals(spark, sf_dir):
    return kb.with_arrival(kept_relations(spark, sf_dir), articles(spark, sf_dir))


def _results(spark, sf_dir):
    docs = articles(spark, sf_dir)
    return kb.article_results(docs, fd.found(spark, sf_dir), fd.linked(spark, sf_dir), kept_relations(spark, sf_dir))


def flattened_relations(spark, sf_dir):
    return longs(kb.flatten_relations(_results(spark, sf_dir)))


def entities(spark, sf_dir):
    return _rounded(kb.entities(_linked_arrivals(spark, sf_dir)))


def mean_confidence(spark, sf_dir):
    return _rounded(kb.entities(_linked_arrivals(spark, sf_dir)).select("type", "text", "confidence"))


def occurrences(spark, sf_dir):
    return kb.entities(_linked_arrivals(spark, sf_dir)).select("type", "text", "confidence_counts")


def first_uri(spark, sf_dir):
    return kb.entities(_linked_arrivals(spark, sf_dir)).select("type", "text", "uri")


def mention_lists(spark, sf_dir):
    lists = kb.mention_lists(_linked_arrivals(spark, sf_dir))
    return lists.select("type", "text", "part", F.array_join("mentions", ",").alias("mentions"))


def node_ids(spark, sf_dir):
    """Ids of linked and of unlinked mentions: the uri, or type_text."""
    linked = fd.linked(spark, sf_dir).select("type", "text", "uri")
    plain = fd.found(spark, sf_dir).select(F.col("label").alias("type"), "text", F.lit("").alias("uri"))
    rows = linked.union(plain).withColumn("node_id", kb.node_id(F.col("type"), F.col("text"), F.col("uri")))
    return rows.groupBy("node_id").agg(F.count(F.lit(1)).alias("n"))


def nodes(spark, sf_dir):
    return _rounded(kb.nodes(_linked_arrivals(spark, sf_dir)).drop("mentions"))


def node_articles(spark, sf_dir):
    rows = kb.node_articles(kb.nodes(_linked_arrivals(spark, sf_dir)))
    first = F.get(F.map_entries("articles"), F.lit(0))
    return longs(rows.select(
        "node_id", "mentions", F.size("articles").alias("n_articles"), first["key"].alias("article_url"),
        F.round(first["value"], 6).alias("confidence"),
    ))


def edges(spark, sf_dir):
    return kb.edges(_relation_arrivals(spark, sf_dir))


def endpoints(spark, sf_dir):
    return kb.endpoint_nodes(edges(spark, sf_dir), kb.nodes(_linked_arrivals(spark, sf_dir)))


def article_counts(spark, sf_dir):
    docs = articles(spark, sf_dir)
    return kb.article_counts(docs, fd.found(spark, sf_dir), fd.linked(spark, sf_dir), kept_relations(spark, sf_dir))


def article_results(spark, sf_dir):
    rows = _results(spark, sf_dir)
    entity = lambda e: F.concat_ws("/", e["pos"].cast("string"), e["text"], e["type"], e["uri"])
    triple = lambda r: F.concat_ws("/", r["sent"].cast("string"), r["subject"], r["predicate"], r["object"])
    return longs(rows.select(
        "article_id", "article_url", F.array_join(F.transform("entities", entity), ";").alias("entities"),
        F.array_join(F.transform("relationships", triple), ";").alias("relationships"), "metadata.*",
    ))


def corpus_totals(spark, sf_dir):
    return kb.corpus_totals(_results(spark, sf_dir))


def default_confidence_edges(spark, sf_dir):
    """Edges of relations without confidence and without url."""
    rows = rl.without_confidence(rl.relations_of_text(articles(spark, sf_dir)))
    rows = rows.withColumn("ord", F.col("article_id")).withColumn("article_url", F.lit(None).cast("string"))
    return kb.edges(rows)


STREAM_FILES = 4


@lru_cache(maxsize=4)
def streamed(spark, sf_dir):
    """The documents as a stream of four micro-batches of several files each, out of order; folded, and read back."""
    path, checkpoint, files = (fresh_path(spark, name) for name in ("kb-stream", "kb-checkpoint", "kb-files"))
    # every batch reads both: they are derived once
    dictionary, candidates = materialise(gazetteer(spark, sf_dir), "gazetteer"), materialise(catalogue(spark, sf_dir), "catalogue")
    documents = table(spark, sf_dir, "documents")
    per_batch = -(-parts(spark) // STREAM_FILES)  # files, so that neither writing nor reading them is left to four tasks
    documents.repartition(STREAM_FILES * per_batch, "doc_id").write.parquet(files)

    def analyse(batch):
        docs = batch.select(
            F.col("doc_id").alias("article_id"), F.col("doc_id").alias("ord"),
            F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("url"), "text",
        )
        mentions = materialise(mn.all_mentions(docs, dictionary), "batch-mentions")
        linked = materialise(plan.linking.link_mentions(mentions, candidates), "batch-linked")
        triples = rl.of_linked_articles(rl.confident(rl.relations_of_text(docs)), linked)
        return kb.with_arrival(linked, docs), kb.with_arrival(triples, docs)

    source = spark.readStream.schema(documents.schema).option("maxFilesPerTrigger", per_batch).parquet(files)
    stream.maintain(source, analyse, path, checkpoint).awaitTermination()
    stream.compact(spark, path)
    return stream.read_knowledge_base(spark, path)


def streamed_entities(spark, sf_dir):
    """The merged batches must equal one run over all documents."""
    return _rounded(streamed(spark, sf_dir)["entities"])


def streamed_lists(spark, sf_dir):
    return streamed(spark, sf_dir)["mention_lists"].withColumn("mentions", F.array_join("mentions", ","))


def streamed_nodes(spark, sf_dir):
    return streamed(spark, sf_dir)["nodes"].select("node_id", "type", "text", "category")


def streamed_edges(spark, sf_dir):
    return streamed(spark, sf_dir)["edges"]


@lru_cache(maxsize=4)
def _run(spark, sf_dir, link):
    options = plan.Options(mention_text="text", feature_text="text")
    return plan.run_articles(articles(spark, sf_dir), gazetteer(spark, sf_dir), catalogue(spark, sf_dir) if link else None, None, options)


def run_entities(spark, sf_dir):
    return _rounded(_run(spark, sf_dir, True)["entities"])


def run_edges(spark, sf_dir):
    return _run(spark, sf_dir, True)["edges"]


def run_nodes(spark, sf_dir):
    return _run(spark, sf_dir, True)["nodes"].select("node_id", "type", "text", "category")


def run_features(spark, sf_dir):
    rows = _run(spark, sf_dir, True)["features"]
    return rows.select("article_id", "num_entities", "unique_entity_types", "num_tokens", "verb_count")


def plain_entities(spark, sf_dir):
    return _rounded(_run(spark, sf_dir, False)["entities"].select("type", "text", "uri", "confidence", "confidence_counts"))


def plain_edges(spark, sf_dir):
    return _run(spark, sf_dir, False)["edges"]


_ROUNDED = "round(confidence, 6) AS confidence"
_LAST_PLAIN = """
    SELECT subject, object, predicate AS relation, 0.5::DOUBLE AS confidence, {url} AS article_url FROM (
        SELECT r.*, a.url, row_number() OVER (PARTITION BY subject, object ORDER BY r.article_id DESC, sent DESC, pos DESC) AS rn
        FROM all_relations r JOIN articles a ON a.article_id = r.article_id) WHERE rn = 1"""
_COUNTS = """
    SELECT a.article_id, count(m.pos) AS total_entities_before_filter,
           coalesce((SELECT count(*) FROM linked l WHERE l.article_id = a.article_id), 0) AS entities_after_filter,
           coalesce((SELECT count(*) FROM relations r WHERE r.article_id = a.article_id), 0) AS relationships_after_filter
    FROM articles a LEFT JOIN doc_mentions m ON m.article_id = a.article_id GROUP BY a.article_id"""
_ENTITIES = o.sql(f"SELECT type, text, uri, {_ROUNDED}, confidence_counts, category FROM kb_entities")
_ALL_RELATIONS = "SELECT article_id, sent, pos, subject, predicate, object, confidence FROM {}"
_LISTS = f"""
    SELECT type, text, ord // {kb.LIST_SPAN} AS part, string_agg(article_url, ',' ORDER BY ord, pos) AS mentions
    FROM arrivals GROUP BY type, text, ord // {kb.LIST_SPAN}"""
_ALL_NODES = """
    SELECT node_id, type, text, category FROM kb_nodes UNION ALL SELECT node_id, NULL, NULL, NULL FROM kb_endpoints"""

QUERIES = {
    "ann1_token_table": (token_table, o.sql("SELECT article_id, sent, i, text, lemma, pos, dep, head_i, is_stop, is_punct FROM tokens")),
    "rel1_relations_of_text": (relations_of_text, o.sql(_ALL_RELATIONS.format("all_relations"))),
    "rel1_relations_of_tokens": (relations_of_tokens, o.sql(
        "SELECT article_id, sent, subject, predicate, object, confidence FROM all_relations")),
    "rel2_subjects": (subjects, o.sql("SELECT subject, count(*) AS n FROM all_relations GROUP BY subject")),
    "rel3_objects": (objects, o.sql("SELECT object, count(*) AS n FROM all_relations GROUP BY object")),
    "rel4_confidence_levels": (confidence_levels, o.sql(
        "SELECT predicate, confidence, count(*) AS n FROM all_relations GROUP BY predicate, confidence")),
    "flt3_confident_relations": (confident_relations, o.sql(
        _ALL_RELATIONS.format("all_relations") + " WHERE confidence >= 0.4::DOUBLE")),
    "rel5_linked_article_relations": (linked_article_relations, o.sql(_ALL_RELATIONS.format("relations"))),
    "rel6_flattened_relations": (flattened_relations, o.sql(_ALL_RELATIONS.format("relations"))),
    "rel7_plain_relations": (plain_relations, o.sql(
        "SELECT article_id, sent, subject, predicate, object, 0.5::DOUBLE AS confidence FROM all_relations")),
    "agg1_entities": (entities, _ENTITIES),
    "agg2_mean_confidence": (mean_confidence, o.sql(f"SELECT type, text, {_ROUNDED} FROM kb_entities")),
    "agg3_occurrences": (occurrences, o.sql("SELECT type, text, count(*) AS confidence_counts FROM linked GROUP BY type, text")),
    "agg4_mention_lists": (mention_lists, o.sql(_LISTS)),
    "agg5_first_uri": (first_uri, o.sql("SELECT type, text, uri FROM firsts")),
    "agg6_node_ids": (node_ids, o.sql("""
        SELECT node_id, count(*) AS n FROM (
            SELECT CASE WHEN uri <> '' THEN uri ELSE type || '_' || text END AS node_id FROM linked
            UNION ALL SELECT label || '_' || text FROM doc_mentions) GROUP BY node_id""")),
    "agg7_nodes": (nodes, o.sql(f"SELECT node_id, type, text, category, article_url, {_ROUNDED} FROM kb_nodes")),
    "agg7_node_articles": (node_articles, o.sql(
        f"SELECT node_id, 1 AS mentions, 1 AS n_articles, article_url, {_ROUNDED} FROM kb_nodes")),
    "agg8_edges": (edges, o.sql("SELECT subject, object, relation, confidence, article_url FROM kb_edges")),
    "agg9_endpoint_nodes": (endpoints, o.sql("SELECT node_id FROM kb_endpoints")),
    "agg10_article_counts": (article_counts, o.sql(_COUNTS)),
    "agg11_article_results": (article_results, o.sql(f"""
        SELECT a.article_id, a.url AS article_url, coalesce(e.entities, '') AS entities,
               coalesce(t.relationships, '') AS relationships, c.total_entities_before_filter, c.entities_after_filter,
               c.relationships_after_filter
        FROM articles a JOIN ({_COUNTS}) c ON c.article_id = a.article_id
        LEFT JOIN (SELECT article_id, string_agg(concat_ws('/', pos, text, type, uri), ';' ORDER BY pos) AS entities
                   FROM linked GROUP BY article_id) e ON e.article_id = a.article_id
        LEFT JOIN (SELECT article_id, string_agg(concat_ws('/', sent, subject, predicate, object), ';' ORDER BY sent, pos)
                   AS relationships FROM relations GROUP BY article_id) t ON t.article_id = a.article_id""")),
    "agg12_corpus_totals": (corpus_totals, o.sql(
        "SELECT (SELECT count(*) FROM linked) AS entities, (SELECT count(*) FROM relations) AS relationships")),
    "agg13_streamed_entities": (streamed_entities, _ENTITIES),
    "agg13_streamed_lists": (streamed_lists, o.sql(_LISTS)),
    "agg13_streamed_nodes": (streamed_nodes, o.sql(_ALL_NODES)),
    "agg13_streamed_edges": (streamed_edges, o.sql("SELECT subject, object, relation, confidence, article_url FROM kb_edges")),
    "agg16_default_confidence_edges": (default_confidence_edges, o.sql(_LAST_PLAIN.format(url="NULL"))),
    "pip1_entities": (run_entities, _ENTITIES),
    "pip1_edges": (run_edges, o.sql("SELECT subject, object, relation, confidence, article_url FROM kb_edges")),
    "pip1_nodes": (run_nodes, o.sql(_ALL_NODES)),
    "pip1_features": (run_features, o.sql("""
        SELECT a.article_id, coalesce(m.n, 0) AS num_entities, coalesce(m.k, 0) AS unique_entity_types,
               coalesce(t.n, 0) AS num_tokens, coalesce(t.v, 0) AS verb_count
        FROM articles a
        LEFT JOIN (SELECT article_id, count(*) AS n, count(DISTINCT label) AS k FROM doc_mentions GROUP BY article_id) m
          ON m.article_id = a.article_id
        LEFT JOIN (SELECT article_id, count(*) AS n, count(*) FILTER (pos = 'VERB') AS v FROM tokens GROUP BY article_id) t
          ON t.article_id = a.article_id""")),
    "pip2_plain_entities": (plain_entities, o.sql("""
        SELECT label AS type, text, '' AS uri, 0.5::DOUBLE AS confidence, count(*) AS confidence_counts
        FROM doc_mentions GROUP BY label, text""")),
    "pip2_plain_edges": (plain_edges, o.sql(_LAST_PLAIN.format(url="url"))),
}
