"""Queries: mentions and links."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from newsgraph.functions.similarity import levenshtein_ratio
from newsgraph.operators import knowledge as kb
from newsgraph.operators import linking as ln
from newsgraph.operators import mentions as mn
from newsgraph.registry import oracle as o
from newsgraph.registry.inputs import articles, catalogue, gazetteer, longs, misspelt, table, turns
from newsgraph.scratch import materialise


def fresh_mentions(spark, sf_dir):
    """All mentions of the documents, computed from the texts."""
    return mn.all_mentions(articles(spark, sf_dir), gazetteer(spark, sf_dir))


@lru_cache(maxsize=8)
def found(spark, sf_dir):
    """All mentions of the documents, staged once per session: linking and counting read them several times."""
    return materialise(fresh_mentions(spark, sf_dir), "mentions")


@lru_cache(maxsize=8)
def linked(spark, sf_dir):
    """Linked mentions, staged once per session."""
    return materialise(ln.link_mentions(found(spark, sf_dir), catalogue(spark, sf_dir)), "linked")


def attribute_mentions(spark, sf_dir):
    return longs(mn.attribute_mentions(articles(spark, sf_dir)).drop("words"))


def entity_mentions(spark, sf_dir):
    return longs(mn.entity_mentions(articles(spark, sf_dir), gazetteer(spark, sf_dir)))


def all_mentions(spark, sf_dir):
    return longs(fresh_mentions(spark, sf_dir))


def exploded_mentions(spark, sf_dir):
    docs = articles(spark, sf_dir)
    return longs(mn.explode_mentions(mn.mention_lists(docs, found(spark, sf_dir))))


def mentions_by_label(spark, sf_dir):
    groups = mn.mentions_by_label(found(spark, sf_dir))
    entry = F.transform(F.array_sort(F.map_keys("groups")), lambda k: F.concat(
        k, F.lit("="), F.array_join(F.try_element_at("groups", k), ",")))
    return groups.select("article_id", F.array_join(entry, ";").alias("groups"))


def no_tokens_no_mentions(spark, sf_dir):
    rows = turns(spark, sf_dir).withColumn("text", F.coalesce("Sentence", F.lit("")))
    lists = mn.mention_lists(rows, mn.all_mentions(rows, gazetteer(spark, sf_dir)))
    return longs(lists.select("article_id", F.size("mentions").alias("n")))


def categories(spark, sf_dir):
    """Mentions per type and category; event types stand in for types outside the taxonomy."""
    labels = found(spark, sf_dir).select(F.col("label").alias("type"))
    labels = labels.union(table(spark, sf_dir, "events").select("event_type"))
    return kb.with_category(labels.groupBy("type").agg(F.count(F.lit(1)).alias("n"))).select("type", "category", "n")


def taxonomy_use(spark, sf_dir):
    """Every type of the taxonomy with its number of mentions."""
    counts = found(spark, sf_dir).groupBy(F.col("label").alias("type")).agg(F.count(F.lit(1)).alias("n"))
    return kb.taxonomy(spark).join(counts, "type", "left").fillna(0)


def distinct_texts(spark, sf_dir):
    return ln.distinct_texts(found(spark, sf_dir)).select("text", "n", "key")


def candidate_pairs(spark, sf_dir):
    return ln.candidates_for(found(spark, sf_dir), catalogue(spark, sf_dir)).withColumn("score", F.round("score", 9))


def fuzzy_candidates(spark, sf_dir):
    pairs = ln.fuzzy_candidates(found(spark, sf_dir), catalogue(spark, sf_dir), 0.6)
    return longs(pairs.withColumn("jaccard", F.round("jaccard", 6)))


def top_candidates(spark, sf_dir):
    return longs(ln.top_candidates(found(spark, sf_dir), catalogue(spark, sf_dir)).withColumn("score", F.round("score", 9)))


def ordered_candidates(spark, sf_dir):
    return longs(ln.ordered_candidates(found(spark, sf_dir), catalogue(spark, sf_dir)).withColumn("score", F.round("score", 9)))


def best_candidate(spark, sf_dir):
    texts = ln.distinct_texts(found(spark, sf_dir))
    best = texts.join(ln.best_candidates(catalogue(spark, sf_dir)), "key")
    return best.select("text", "label", "item", F.round("score", 9).alias("score"))


def matching_ratio(spark, sf_dir):
    """Similarity of every candidate label to its mention text."""
    pairs = ln.candidates_for(found(spark, sf_dir), catalogue(spark, sf_dir)).select("text", "label").distinct()
    return pairs.select("text", "label", F.round(ln.matching_ratio(F.col("text"), F.col("label")), 6).alias("similarity"))


def edit_ratio(spark, sf_dir):
    """Names and types of parts; their characters are one byte each, as the checking SQL counts bytes."""
    pairs = table(spark, sf_dir, "part").select(F.col("p_name").alias("text"), F.lower("p_type").alias("label")).distinct()
    return pairs.select("text", "label", F.round(levenshtein_ratio(F.col("text"), F.col("label")), 6).alias("similarity"))


def links(spark, sf_dir):
    """Link of every distinct text, malformed candidates included."""
    return ln.link_texts(found(spark, sf_dir), catalogue(spark, sf_dir)).withColumn("confidence", F.round("confidence", 6))


FUZZY = 0.6


def fuzzy_links(spark, sf_dir):
    """Link of every distinct text by search; confidences that are no score are left to lnk8_link_confidence and pytest."""
    rows = ln.linked_texts(found(spark, sf_dir), misspelt(catalogue(spark, sf_dir)), fuzzy=FUZZY)
    scored = F.when(F.col("score").isNotNull() | (F.col("uri") == ""), F.round("confidence", 6))
    return rows.select("text", "n", "label", "uri", F.round("jaccard", 6).alias("jaccard"), scored.alias("confidence"))


def fuzzy_linked_rows(spark, sf_dir):
    """Mentions whose candidate by search has a score that passes the threshold."""
    scored = misspelt(catalogue(spark, sf_dir).where("score IS NOT NULL"))
    rows = ln.link_mentions(found(spark, sf_dir), scored, fuzzy=FUZZY)
    return longs(rows.withColumn("confidence", F.round("confidence", 6)))


def malformed(spark, sf_dir):
    rows = ln.link_texts(found(spark, sf_dir), catalogue(spark, sf_dir))
    return rows.where("uri = ''").select("text", "n", "uri", "confidence")


def malformed_scores(spark, sf_dir):
    """Candidates of items in 5 have a score that is no number."""
    text = F.when(F.col("item").endswith("5"), "many").otherwise(F.col("score").cast("string"))
    rows = ln.link_texts(found(spark, sf_dir), catalogue(spark, sf_dir).withColumn("score", text))
    return rows.where("uri = ''").select("text", "n", "uri", "confidence")


def unlinked(spark, sf_dir):
    return ln.unlinked_texts(found(spark, sf_dir), catalogue(spark, sf_dir))


def linked_rows(spark, sf_dir):
    rows = ln.link_mentions(found(spark, sf_dir), catalogue(spark, sf_dir))
    return longs(rows.withColumn("confidence", F.round("confidence", 6)))


def confident_entities(spark, sf_dir):
    """Entities per confidence value at a higher threshold."""
    rows = ln.link_mentions(found(spark, sf_dir), catalogue(spark, sf_dir), threshold=0.6)
    return rows.groupBy("type", F.round("confidence", 6).alias("confidence")).agg(F.count(F.lit(1)).alias("n"))


# pg_trgm style: two blanks before, one after
_GRAMS = """
    SELECT DISTINCT s, substr('  ' || s || ' ', i, 3) AS g
    FROM (SELECT s, unnest(range(1, length(s) + 2)) AS i FROM {source})"""

_FUZZY = f"""
    SELECT text, label, n AS overlap, n::DOUBLE / (a.size + b.size - n) AS jaccard
    FROM (SELECT t.s AS text, l.s AS label, count(*) AS n FROM ({_GRAMS.format(source='fuzzy_texts')}) t
          JOIN ({_GRAMS.format(source='fuzzy_labels')}) l ON t.g = l.g GROUP BY t.s, l.s) p
    JOIN (SELECT s, count(*) AS size FROM ({_GRAMS.format(source='fuzzy_texts')}) GROUP BY s) a ON a.s = text
    JOIN (SELECT s, count(*) AS size FROM ({_GRAMS.format(source='fuzzy_labels')}) GROUP BY s) b ON b.s = label
    WHERE n >= 0.6::DOUBLE * (a.size + b.size - n)"""

o.CTES["fuzzy_texts"] = "SELECT DISTINCT lower(trim(text)) AS s FROM doc_mentions WHERE trim(text) <> ''"
o.CTES["fuzzy_labels"] = "SELECT DISTINCT lower(trim(label)) AS s FROM catalogue WHERE trim(label) <> ''"
o.CTES["fuzzy_pairs"] = _FUZZY
_BEST = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC NULLS LAST, item ASC NULLS LAST, label) AS rn
                   FROM {source}) WHERE rn = 1"""
o.CTES["misspelt"] = """
    SELECT lower(trim(label)) AS key, * FROM (
        SELECT CASE WHEN length(trim(label)) >= 6 THEN substr(label, 1, 3) || substr(label, 3) ELSE label END AS label, item, score FROM catalogue)"""
o.CTES["misspelt_scored"] = "SELECT * FROM misspelt WHERE score IS NOT NULL"
for _name in ("misspelt", "misspelt_scored"):
    o.CTES[f"{_name}_labels"] = f"SELECT DISTINCT key AS s FROM {_name} WHERE key <> ''"
    o.CTES[f"{_name}_pairs"] = _FUZZY.replace("fuzzy_labels", f"{_name}_labels")
    o.CTES[f"{_name}_nearest"] = f"""
        SELECT text AS key, label AS label_key, jaccard FROM (
            SELECT *, row_number() OVER (PARTITION BY text ORDER BY jaccard DESC, text <> label, abs(length(text) - length(label)), label) AS rn
            FROM {_name}_pairs) WHERE rn = 1"""
    o.CTES[f"{_name}_best"] = _BEST.format(source=_name)
o.CTES["fuzzy_links"] = """
    SELECT m.text, m.n, b.label, CASE WHEN b.item IS NULL THEN '' ELSE b.item END AS uri, round(s.jaccard, 6) AS jaccard,
           CASE WHEN b.item IS NULL THEN 0.1::DOUBLE ELSE round(b.score, 6) END AS confidence
    FROM mention_texts m JOIN misspelt_nearest s ON s.key = lower(trim(m.text)) JOIN misspelt_best b ON b.key = s.label_key"""
o.CTES["fuzzy_linked"] = """
    SELECT d.article_id, d.pos, d.text, d.label AS type, coalesce(b.item, '') AS uri,
           round(CASE WHEN b.item IS NULL THEN 0.1::DOUBLE ELSE b.score END, 6) AS confidence
    FROM doc_mentions d JOIN misspelt_scored_nearest s ON s.key = lower(trim(d.text)) JOIN misspelt_scored_best b ON b.key = s.label_key
    WHERE CASE WHEN b.item IS NULL THEN 0.1::DOUBLE ELSE b.score END >= 0.5::DOUBLE"""
o.refresh()

_LINKED = "round(confidence, 6) AS confidence"

QUERIES = {
    "ner1_attribute_mentions": (attribute_mentions, o.sql("SELECT article_id, pos, text, label FROM doc_attributes")),
    "ner1_all_mentions": (all_mentions, o.sql("SELECT article_id, pos, text, label FROM doc_mentions")),
    "ner2_entity_mentions": (entity_mentions, o.sql("SELECT article_id, pos, words, text, label FROM doc_entities")),
    "ner3_exploded_mentions": (exploded_mentions, o.sql("SELECT article_id, pos, text, label FROM doc_mentions")),
    "ner4_mentions_by_label": (mentions_by_label, o.sql("""
        SELECT article_id, string_agg(label || '=' || texts, ';' ORDER BY label) AS groups
        FROM (SELECT article_id, label, string_agg(text, ',' ORDER BY pos) AS texts FROM doc_mentions GROUP BY article_id, label)
        GROUP BY article_id""")),
    "flt5_no_tokens_no_mentions": (no_tokens_no_mentions, o.sql("""
        SELECT t.article_id, count(m.pos) AS n FROM turns t LEFT JOIN raw_turn_mentions m ON m.article_id = t.article_id
        GROUP BY t.article_id""")),
    "flt6_type_category": (categories, o.sql(f"""
        SELECT type, CASE WHEN type IN {o._list(o.lx.ENTITY_TYPES)} THEN 'entities' ELSE 'attributes' END AS category, count(*) AS n
        FROM (SELECT label AS type FROM doc_mentions UNION ALL SELECT event_type FROM events) GROUP BY type""")),
    "flt7_taxonomy_use": (taxonomy_use, o.sql(f"""
        SELECT x.type, CASE WHEN x.type IN {o._list(o.lx.ENTITY_TYPES)} THEN 'entities' ELSE 'attributes' END AS category,
               count(m.label) AS n
        FROM (SELECT unnest({o._ALL_TYPES}) AS type) x LEFT JOIN doc_mentions m ON m.label = x.type GROUP BY x.type""")),
    "lnk1_distinct_texts": (distinct_texts, o.sql("SELECT text, n, lower(trim(text)) AS key FROM mention_texts")),
    "lnk2_candidate_pairs": (candidate_pairs, o.sql("SELECT text, label, item, round(score, 9) AS score FROM pairs")),
    "lnk3_fuzzy_candidates": (fuzzy_candidates, o.sql(
        "SELECT text, label, overlap, round(jaccard, 6) AS jaccard FROM fuzzy_pairs")),
    "lnk4_top_candidates": (top_candidates, o.sql(
        "SELECT text, rank, label, item, round(score, 9) AS score FROM pairs WHERE rank <= 5")),
    "lnk5_ordered_candidates": (ordered_candidates, o.sql(
        "SELECT text, rank, label, item, round(score, 9) AS score FROM pairs")),
    "lnk6_best_candidate": (best_candidate, o.sql(
        "SELECT text, label, item, round(score, 9) AS score FROM pairs WHERE rank = 1")),
    "lnk7_matching_ratio": (matching_ratio, o.sql("""
        SELECT DISTINCT text, label, round(2.0::DOUBLE * length(text) / (length(text) + length(label)), 6) AS similarity
        FROM pairs""")),
    "lnk7_edit_ratio": (edit_ratio, """
        SELECT DISTINCT p_name AS text, lower(p_type) AS label, round(1.0::DOUBLE - levenshtein(p_name, lower(p_type))::DOUBLE
               / greatest(length(p_name), length(p_type)), 6) AS similarity FROM part"""),
    "lnk8_link_confidence": (links, o.sql(f"SELECT text, n, uri, {_LINKED} FROM links")),
    "lnk8_fuzzy_links": (fuzzy_links, o.sql("SELECT * FROM fuzzy_links")),
    "lnk11_fuzzy_linked": (fuzzy_linked_rows, o.sql("SELECT * FROM fuzzy_linked")),
    "lnk9_malformed_candidates": (malformed, o.sql("""
        SELECT text, n, '' AS uri, 0.1::DOUBLE AS confidence FROM pairs WHERE rank = 1 AND item IS NULL""")),
    "lnk9_bad_scores": (malformed_scores, o.sql(f"""
        SELECT m.text, m.n, '' AS uri, 0.1::DOUBLE AS confidence FROM mention_texts m
        JOIN ({_BEST.format(source="(SELECT key, label, item, CASE WHEN item LIKE '%5' THEN NULL ELSE score END AS score FROM candidates)")}) b
          ON b.key = lower(trim(m.text))
        WHERE b.item IS NULL OR b.item LIKE '%5'""")),
    "lnk10_unlinked_texts": (unlinked, o.sql("""
        SELECT text, n FROM mention_texts WHERE lower(trim(text)) NOT IN (SELECT key FROM candidates)""")),
    "lnk11_linked_entities": (linked_rows, o.sql(
        f"SELECT article_id, pos, text, type, uri, {_LINKED} FROM linked")),
    "flt2_confident_entities": (confident_entities, o.sql("""
        SELECT m.label AS type, round(l.confidence, 6) AS confidence, count(*) AS n
        FROM doc_mentions m JOIN links l ON m.text = l.text WHERE l.confidence >= 0.6::DOUBLE GROUP BY 1, 2""")),
}
