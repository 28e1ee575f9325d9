"""The knowledge base: entity table, mention lists, node and edge tables, per-article results.

Arrival order is explicit: `ord` is the article's order, `pos` the place inside the article. Every upsert is a min, max,
sum or count, so all of them combine before the shuffle and a frequent entity costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgraph import lexicon as lx

# Mention lists are cut into one list per this many consecutive article orders, so no list grows with the corpus.
LIST_SPAN = 1024


def taxonomy(spark: SparkSession) -> DataFrame:
    """(type, category): the 11 entity and 14 attribute types."""
    rows = [(t, "entities") for t in lx.ENTITY_TYPES] + [(t, "attributes") for t in lx.ATTRIBUTE_TYPES]
    return spark.createDataFrame(rows, "type string, category string")


def with_category(df: DataFrame) -> DataFrame:
    """Add the category of `type`; a type outside the taxonomy is an attribute. 25 literal rows are broadcast."""
    return df.join(F.broadcast(taxonomy(df.sparkSession)), "type", "left").withColumn(
        "category", F.coalesce("category", F.lit("attributes"))
    )


def node_id(type_: Column, text: Column, uri: Column) -> Column:
    return F.coalesce(F.nullif(uri, F.lit("")), F.concat_ws("_", type_, text))


def entities(linked: DataFrame) -> DataFrame:
    """(type, text, uri, confidence, confidence_counts, category); `linked` has ord, pos, text, type, uri, confidence.

    The uri is the first arrival's; the confidence is the mean over all arrivals.
    """
    upserts = linked.groupBy("type", "text").agg(
        F.min_by("uri", F.struct("ord", "pos")).alias("uri"),
        F.avg("confidence").alias("confidence"),
        F.count(F.lit(1)).alias("confidence_counts"),
    )
    return with_category(upserts).select("type", "text", "uri", "confidence", "confidence_counts", "category")


def mention_lists(linked: DataFrame, span: int = LIST_SPAN) -> DataFrame:
    """(type, text, part, mentions ARRAY<url>): one url per occurrence in arrival order, duplicates kept.

    The list of an entity is the concatenation of its parts in order of `part`. A part covers `span` article orders;
    one list per entity would put every occurrence of a frequent entity into a single row.
    """
    part = F.floor(F.col("ord") / F.lit(span)).alias("part")
    ordered = F.sort_array(F.collect_list(F.struct("ord", "pos", "article_url")))
    return linked.groupBy("type", "text", part).agg(F.transform(ordered, lambda m: m["article_url"]).alias("mentions"))


def nodes(linked: DataFrame) -> DataFrame:
    """(node_id, type, text, category, article_url, confidence, mentions): one row per node id.

    A node is written when its (type, text) first arrives; a later (type, text) with the same id overwrites it.
    `mentions` is therefore 1 and the article that of the last first arrival.
    """
    first = linked.groupBy("type", "text").agg(
        F.min(F.struct("ord", "pos", "uri", "article_url", "confidence")).alias("first")
    ).select("type", "text", "first.*")
    first = first.withColumn("node_id", node_id(F.col("type"), F.col("text"), F.col("uri")))
    last = first.groupBy("node_id").agg(
        F.max(F.struct("ord", "pos", "type", "text", "article_url", "confidence")).alias("last")
    ).select("node_id", "last.*")
    return with_category(last).select(
        "node_id", "type", "text", "category", "article_url", "confidence", F.lit(1).alias("mentions")
    )


def node_articles(node_table: DataFrame) -> DataFrame:
    """Nodes with `articles` as a map url -> confidence."""
    return node_table.withColumn("articles", F.create_map("article_url", "confidence"))


def edges(relations: DataFrame) -> DataFrame:
    """(subject, object, relation, confidence, article_url): the last arrival per (subject, object) wins.

    `relations` has ord, sent, pos, subject, predicate, object, confidence, article_url; a missing confidence is 0.5.
    """
    last = F.struct(
        "ord", "sent", "pos", F.col("predicate").alias("relation"),
        F.coalesce("confidence", F.lit(lx.DEFAULT_CONFIDENCE)).alias("confidence"), "article_url",
    )
    return relations.groupBy("subject", "object").agg(F.max(last).alias("last")).select(
        "subject", "object", "last.relation", "last.confidence", "last.article_url"
    )


def endpoint_nodes(edge_table: DataFrame, node_table: DataFrame) -> DataFrame:
    """(node_id): edge endpoints that are no node yet."""
    ends = edge_table.select(F.explode(F.array("subject", "object")).alias("node_id")).distinct()
    return ends.join(node_table.select("node_id"), "node_id", "left_anti")


def all_nodes(node_table: DataFrame, edge_table: DataFrame) -> DataFrame:
    """Node table plus the endpoints without attributes."""
    return node_table.unionByName(endpoint_nodes(edge_table, node_table), allowMissingColumns=True)


def article_counts(articles: DataFrame, mentions: DataFrame, linked: DataFrame, relations: DataFrame) -> DataFrame:
    """(article_id, three counts): mentions before the filter, entities and relations after it."""
    ones = [
        side.select("article_id", *[F.lit(int(i == j)).alias(n) for j, n in enumerate(COUNT_NAMES)])
        for i, side in enumerate([mentions, linked, relations])
    ]
    base = articles.select("article_id", *[F.lit(0).alias(n) for n in COUNT_NAMES])
    # One union and one grouping instead of three groupings and three joins.
    everything = base.union(ones[0]).union(ones[1]).union(ones[2])
    return everything.groupBy("article_id").agg(*[F.sum(n).alias(n) for n in COUNT_NAMES])


COUNT_NAMES = ["total_entities_before_filter", "entities_after_filter", "relationships_after_filter"]


def article_results(articles: DataFrame, mentions: DataFrame, linked: DataFrame, relations: DataFrame) -> DataFrame:
    """One row per article: url, entities, relationships, metadata counts. Lists are bounded by the article's text."""
    found = linked.groupBy("article_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "text", "type", "uri", "confidence"))).alias("entities")
    )
    triples = relations.groupBy("article_id").agg(
        F.sort_array(F.collect_list(F.struct("sent", "pos", "subject", "predicate", "object", "confidence"))).alias("relationships")
    )
    before = mentions.groupBy("article_id").agg(F.count(F.lit(1)).alias("_before"))
    no_entities = F.array().cast(linked_type(linked))
    no_triples = F.array().cast(relation_type(relations))
    joined = (
        articles.select("article_id", F.col("url").alias("article_url"))
        .join(before, "article_id", "left").join(found, "article_id", "left").join(triples, "article_id", "left")
    )
    joined = joined.withColumn("entities", F.coalesce("entities", no_entities)).withColumn(
        "relationships", F.coalesce("relationships", no_triples)
    )
    return joined.select(
        "article_id", "article_url", "entities", "relationships",
        F.struct(
            F.coalesce("_before", F.lit(0)).cast("int").alias(COUNT_NAMES[0]),
            F.size("entities").alias(COUNT_NAMES[1]),
            F.size("relationships").alias(COUNT_NAMES[2]),
        ).alias("metadata"),
    )


def _struct_type(df: DataFrame, columns: list[str]) -> str:
    fields = ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in columns)
    return f"array<struct<{fields}>>"


def linked_type(linked: DataFrame) -> str:
    return _struct_type(linked, ["pos", "text", "type", "uri", "confidence"])


def relation_type(relations: DataFrame) -> str:
    return _struct_type(relations, ["sent", "pos", "subject", "predicate", "object", "confidence"])


def flatten_relations(results: DataFrame) -> DataFrame:
    """(article_id, sent, pos, subject, predicate, object, confidence) of all articles."""
    return results.select("article_id", F.explode("relationships").alias("r")).select("article_id", "r.*")


def corpus_totals(results: DataFrame) -> DataFrame:
    """Numbers of entities and relations over all articles."""
    return results.agg(
        F.sum("metadata.entities_after_filter").cast("long").alias("entities"),
        F.sum("metadata.relationships_after_filter").cast("long").alias("relationships"),
    )


def with_arrival(df: DataFrame, articles: DataFrame) -> DataFrame:
    """Add `ord` and `article_url` of the article to rows keyed by article_id."""
    return df.join(articles.select("article_id", F.col("ord"), F.col("url").alias("article_url")), "article_id")
