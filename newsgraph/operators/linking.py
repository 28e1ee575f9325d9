"""Linking mentions to a candidate catalogue.

`catalogue(label, item, score)` may hold many candidates per label; `score` is a number or a numeric string and may be
null. Mentions repeat heavily, so every lookup runs over the distinct mention texts and over catalogue rows that are
already reduced per label; only the last join touches all mentions, and it salts frequent texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.functions.similarity import levenshtein_ratio, matching_ratio, trigram_codes
from newsgraph.operators.scale import HOT_ROWS, broadcast_if_small, lookup_join, range_rank
from newsgraph.scratch import materialise


def lookup_key(text: Column) -> Column:
    return F.lower(F.trim(text))


def distinct_texts(mentions: DataFrame) -> DataFrame:
    """(text, n, key): every mention text once, with its number of occurrences."""
    return mentions.groupBy("text").agg(F.count(F.lit(1)).alias("n")).withColumn("key", lookup_key(F.col("text")))


def _candidates(catalogue: DataFrame) -> DataFrame:
    score = F.col("score").cast("string").try_cast("double")
    return catalogue.select(
        lookup_key(F.col("label")).alias("key"), F.col("label"), F.col("item"), score.alias("score"),
        (F.col("score").isNotNull() & score.isNull()).alias("bad_score"),
    )


def _best_first() -> list[Column]:
    return [F.desc_nulls_last("score"), F.asc_nulls_last("item"), F.asc("label")]


def _with_candidate_counts(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows of `texts` whose key has candidates, with their number `_candidates`; staged, as salted joins read it twice."""
    counts = candidates.groupBy("key").agg(F.count(F.lit(1)).alias("_candidates"))
    return materialise(texts.join(counts, "key"), "mentioned-keys")


def candidates_for(mentions: DataFrame, catalogue: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(text, label, item, score): all candidates of every distinct mention text.

    A label with very many candidates is spread over several join tasks.
    """
    found = _candidates(catalogue)
    texts = _with_candidate_counts(distinct_texts(mentions), found)
    joined = lookup_join(found, texts, "key", "_candidates", ["item", "label"], hot_rows=hot_rows)
    return joined.select("text", "label", "item", "score")


def top_candidates(mentions: DataFrame, catalogue: DataFrame, limit: int = lx.TOP_CANDIDATES) -> DataFrame:
    """(text, rank, label, item, score): the best `limit` candidates of every distinct mention text.

    The limit is applied per catalogue label before the join, and Spark prunes each map partition to `limit` rows per
    label before the shuffle, so a label with millions of candidates costs `limit` rows per task.
    """
    order = Window.partitionBy("key").orderBy(*_best_first())
    best = _candidates(catalogue).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    return distinct_texts(mentions).join(best, "key").select("text", "rank", "label", "item", "score")


def ordered_candidates(mentions: DataFrame, catalogue: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(text, rank, label, item, score): all candidates, best first, one row each.

    Only labels that are mentioned are ranked; a label with very many candidates is joined and ranked by several tasks.
    """
    found = _candidates(catalogue)
    texts = _with_candidate_counts(distinct_texts(mentions), found)
    keys = texts.select("key", "_candidates").distinct()
    wanted = lookup_join(found, keys, "key", "_candidates", ["item", "label"], hot_rows=hot_rows).drop("_candidates")
    ranked = range_rank(wanted, ["key"], _best_first())
    joined = lookup_join(ranked, texts, "key", "_candidates", ["item", "label"], hot_rows=hot_rows)
    return joined.select("text", "rank", "label", "item", "score")


def best_candidates(catalogue: DataFrame) -> DataFrame:
    """(key, label, item, score, bad_score): the first candidate of every label key, combined before the shuffle."""
    first = F.struct(
        F.coalesce(-F.col("score"), F.lit(math.inf)).alias("worst_last"),
        F.col("item").isNull().alias("no_item"), "item", "label",
    )
    return (
        _candidates(catalogue)
        .groupBy("key")
        .agg(F.min_by(F.struct("label", "item", "score", "bad_score"), first).alias("best"))
        .select("key", "best.*")
    )


def confidence_of(score: Column, similarity: Column) -> Column:
    """Candidate score if there is one, else the similarity of text and label."""
    return F.coalesce(score, similarity)


def link_texts(mentions: DataFrame, catalogue: DataFrame, builtin_similarity: bool = False, fuzzy: float | None = None) -> DataFrame:
    """(text, n, uri, confidence): the link of every distinct mention text that has a candidate.

    Without `fuzzy` only equal keys are candidates. With it the catalogue is searched: the label most like the text is
    its candidate, if their trigrams reach that Jaccard similarity. A candidate without an item, or with a score that is
    no number, gives an empty uri and confidence 0.1. The similarity runs once per distinct text.
    """
    return linked_texts(mentions, catalogue, builtin_similarity, fuzzy).select("text", "n", "uri", "confidence")


def linked_texts(mentions: DataFrame, catalogue: DataFrame, builtin_similarity: bool = False, fuzzy: float | None = None) -> DataFrame:
    """`link_texts` with the label and its score, as the candidate has them, and the similarity of keys (1 if equal)."""
    texts, best = distinct_texts(mentions), best_candidates(catalogue)
    if fuzzy is None:
        found = texts.join(best, "key").withColumn("jaccard", F.lit(1.0))
    else:
        near = nearest_labels(texts, catalogue, fuzzy)
        found = texts.join(near, "key").join(best.withColumnRenamed("key", "label_key"), "label_key")
    malformed = F.col("item").isNull() | F.col("bad_score")
    compare = ~malformed & F.col("score").isNull()
    ratio = levenshtein_ratio if builtin_similarity else matching_ratio
    similarity = ratio(F.when(compare, F.col("text")), F.when(compare, F.coalesce("label", F.lit(""))))
    return found.select(
        "text", "n", "label", "score", "jaccard",
        F.when(malformed, F.lit("")).otherwise(F.col("item")).alias("uri"),
        F.when(malformed, F.lit(lx.MALFORMED_CONFIDENCE)).otherwise(confidence_of(F.col("score"), similarity)).alias("confidence"),
    )


def link_mentions(
    mentions: DataFrame,
    catalogue: DataFrame,
    threshold: float | None = lx.ENTITY_THRESHOLD,
    builtin_similarity: bool = False,
    hot_rows: int = HOT_ROWS,
    fuzzy: float | None = None,
) -> DataFrame:
    """(article_id, pos, text, type, uri, confidence) of the linked mentions with confidence >= threshold.

    Mentions without a candidate are dropped; `fuzzy` searches for one, see `link_texts`. The threshold is applied to the
    links before they meet the mentions. The links, one row per distinct text, are written to the shared folder: the join
    reads them twice.
    """
    links = link_texts(mentions, catalogue, builtin_similarity, fuzzy)
    if threshold is not None:
        links = links.where(F.col("confidence") >= F.lit(threshold))
    links = materialise(links, "links")
    joined = lookup_join(mentions, links, "text", "n", ["article_id", "pos"], hot_rows=hot_rows)
    return joined.select("article_id", "pos", "text", F.col("label").alias("type"), "uri", "confidence")


def unlinked_texts(mentions: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(text, n): distinct mention texts without any candidate."""
    keys = catalogue.select(lookup_key(F.col("label")).alias("key")).distinct()
    return distinct_texts(mentions).join(keys, "key", "left_anti").select("text", "n")


def _in_parts(side: DataFrame, identity: str, own: str, other: str) -> DataFrame:
    """Number the part a row falls into on its own side, and copy the row once per part of the other side."""
    mine = F.when(F.col(own).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(identity), F.col(own).cast("long")).cast("int"))
    copies = F.coalesce(F.col(other), F.lit(1))
    return side.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0), copies - 1)))


def _distinct_keys(column: Column, rows: DataFrame, name: str, identity: str) -> DataFrame:
    """(identity, name): every key of a column once, numbered; written, as numbers must not change between uses."""
    keys = rows.select(lookup_key(column).alias(name)).where(F.col(name) != "").distinct()
    return materialise(keys.select(F.monotonically_increasing_id().alias(identity), name), "keys")


def _rare_first(keys: DataFrame, name: str, identity: str, frequency: DataFrame, own: str) -> DataFrame:
    """(identity, grams): the trigrams of every key, from rare to frequent among the labels."""
    rows = keys.select(identity, F.explode(trigram_codes(F.col(name))).alias("gram"))
    rows = lookup_join(rows, frequency, "gram", own, [identity])
    ordered = F.array_sort(F.collect_list(F.struct("n_labels", "gram")))
    return materialise(rows.groupBy(identity).agg(F.transform(ordered, lambda g: g["gram"]).alias("grams")), "trigrams")


def _prefixes(sets: DataFrame, identity: str, threshold: float) -> DataFrame:
    """(gram, identity, size, place, before): the trigrams by which a set is found, and those before each of them."""
    size = F.size("grams")
    keep = (size - F.ceil(F.lit(threshold) * size - F.lit(1e-9)) + 1).cast("int")
    rows = sets.select(identity, size.alias("size"), F.slice("grams", F.lit(1), keep).alias("prefix"))
    rows = rows.select(identity, "size", "prefix", F.posexplode("prefix").alias("place", "gram"))
    return rows.select("gram", identity, "size", "place", F.slice("prefix", F.lit(1), F.col("place")).alias("before"))


def fuzzy_candidates(mentions: DataFrame, catalogue: DataFrame, threshold: float = 0.5, hot_block: int = 10_000) -> DataFrame:
    """(text, label, overlap, jaccard): distinct texts and labels whose character trigrams reach the Jaccard threshold.

    Exact set-similarity join by prefix and positional filtering: order each string's trigrams from rare to frequent; two
    strings can only reach the threshold if they share a trigram among the first n - ceil(t * n) + 1 of each. A pair is
    kept at its first common trigram only, and only if what follows there in both can still bring the overlap up to the
    threshold. Numbers and sizes travel to that join; whole trigram sets meet the pairs that are left, once. Blocks with
    more than `hot_block` rows on a side are spread over several tasks; nothing is dropped.
    """
    texts = _distinct_keys(F.col("text"), mentions, "text", "tid")
    labels = _distinct_keys(F.col("label"), catalogue, "label", "lid")
    # Any fixed order of trigrams is exact; the order by label frequency keeps the blocks small.
    occurrences = texts.select(F.explode(trigram_codes(F.col("text"))).alias("gram"), F.lit(1).alias("t"), F.lit(0).alias("l")).union(
        labels.select(F.explode(trigram_codes(F.col("label"))).alias("gram"), F.lit(0).alias("t"), F.lit(1).alias("l"))
    )
    counted = occurrences.groupBy("gram").agg(F.sum("t").alias("n_texts"), F.sum("l").alias("n_labels"))
    frequency = materialise(counted, "trigram-frequency")
    text_sets = _rare_first(texts, "text", "tid", frequency, "n_texts")
    label_sets = _rare_first(labels, "label", "lid", frequency, "n_labels")
    left = _prefixes(text_sets, "tid", threshold)
    right = _prefixes(label_sets, "lid", threshold).select(
        "gram", "lid", *[F.col(c).alias(f"label_{c}") for c in ("size", "place", "before")]
    )
    # Split both sides of a hot block into parts; each part of one side meets every part of the other.
    blocks = left.groupBy("gram").agg(F.count(F.lit(1)).alias("_texts")).join(
        right.groupBy("gram").agg(F.count(F.lit(1)).alias("_labels")), "gram"
    )
    hot = blocks.where((F.col("_texts") > hot_block) | (F.col("_labels") > hot_block)).select(
        "gram",
        F.ceil(F.col("_texts") / hot_block).cast("int").alias("_tparts"),
        F.ceil(F.col("_labels") / hot_block).cast("int").alias("_lparts"),
    )
    hot = materialise(hot, "hot-trigrams")
    hot = broadcast_if_small(hot)
    left = _in_parts(left.join(hot, "gram", "left"), "tid", "_tparts", "_lparts")
    right = _in_parts(right.join(hot, "gram", "left"), "lid", "_lparts", "_tparts")
    both = F.col("size") + F.col("label_size")
    near = (F.col("label_size") >= F.lit(threshold) * F.col("size")) & (F.col("size") >= F.lit(threshold) * F.col("label_size"))
    reach = F.least(F.col("size") - F.col("place"), F.col("label_size") - F.col("label_place"))
    enough = reach >= F.lit(threshold / (1 + threshold)) * both - F.lit(1e-9)
    first = ~F.arrays_overlap("before", "label_before")
    pairs = left.join(right, ["gram", "_tparts", "_lparts"]).where(near & enough & first).select("tid", "lid")
    pairs = pairs.join(broadcast_if_small(text_sets), "tid").join(broadcast_if_small(label_sets.withColumnRenamed("grams", "label_grams")), "lid")
    pairs = pairs.select(
        "tid", "lid", F.size(F.array_intersect("grams", "label_grams")).alias("overlap"), (F.size("grams") + F.size("label_grams")).alias("both")
    )
    union = F.col("both") - F.col("overlap")
    pairs = pairs.where(F.col("overlap") >= F.lit(threshold) * union)
    named = pairs.join(broadcast_if_small(texts), "tid").join(broadcast_if_small(labels), "lid")
    return named.select("text", "label", "overlap", (F.col("overlap") / union).alias("jaccard"))


def nearest_labels(texts: DataFrame, catalogue: DataFrame, threshold: float) -> DataFrame:
    """(key, label_key, jaccard): the label key most like each key of `texts`, if one reaches the threshold.

    Ties go to the equal key, then to the label nearest in length, then to the one that sorts first. The best one is found
    by a minimum, which combines before the shuffle, so a text with very many similar labels is no large group.
    """
    pairs = fuzzy_candidates(texts, catalogue, threshold)
    away = F.abs(F.char_length("text") - F.char_length("label"))
    order = F.struct((-F.col("jaccard")).alias("j"), (F.col("text") != F.col("label")).alias("other"), away.alias("away"), F.col("label").alias("label_key"))
    best = pairs.groupBy(F.col("text").alias("key")).agg(F.min(order).alias("best"))
    return best.select("key", "best.label_key", (-F.col("best.j")).alias("jaccard"))
