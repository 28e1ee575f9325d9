"""Subject-predicate-object relations from dependency annotations.

Two routes give the same rows. `relations_of_text` annotates sentences by rule and builds the triple inside the
sentence's row. `relations_of_tokens` takes any token table, for example one produced by a parser.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.functions import annotate as an
from newsgraph.functions import text as tx


def annotate(articles: DataFrame, text: str = "text") -> DataFrame:
    """Token table by rule: one row per token, (article_id, sent, i, text, lemma, pos, dep, head_i, is_stop, is_punct).

    `i` counts tokens through the whole article, `sent` sentences; both start at 0. The first anchor verb of a
    sentence is its ROOT, the nearest content words on its sides are subject and object; a token of a sentence
    without an anchor verb is its own head. No shuffle.
    """
    cut = articles.select(
        "article_id", F.transform(tx.sentences(tx.filled(F.col(text))), tx.word_tokens).alias("_tokens")
    )
    cut = cut.withColumn("_roles", F.transform("_tokens", lambda t: an.roles(an.lowered(t))))
    cut = cut.withColumn("_anchors", F.transform("_roles", an.anchor_at))
    cut = cut.withColumn("_subjects", F.zip_with("_roles", "_anchors", an.subject_at))
    cut = cut.withColumn("_objects", F.zip_with("_roles", "_anchors", an.object_at))

    def rows(tokens, sent):
        return F.transform(tokens, lambda t, k: F.struct(
            sent.alias("sent"), (k + 1).alias("k"), t.alias("text"),
            F.get("_anchors", sent).alias("a"), F.get("_subjects", sent).alias("s"), F.get("_objects", sent).alias("o"),
        ))

    flat = cut.select("article_id", F.posexplode(F.flatten(F.transform("_tokens", rows))).alias("i", "t"))
    k, a = F.col("t.k"), F.col("t.a")
    dep = F.when(a == 0, "dep").when(k == a, "ROOT").when(k == F.col("t.s"), "nsubj").when(k == F.col("t.o"), "dobj").otherwise("dep")
    head = F.when(a == 0, F.col("i")).otherwise(F.col("i") - k + a)
    word = F.col("word")
    return flat.withColumn("word", F.lower("t.text")).select(
        "article_id", F.col("t.sent").alias("sent"), "i", F.col("t.text").alias("text"),
        an.lemma(word).alias("lemma"), an.pos_tag(word).alias("pos"), dep.alias("dep"), head.alias("head_i"),
        tx.is_stop_word(word).alias("is_stop"), an.is_punct(word).alias("is_punct"),
    )


def relations_of_text(articles: DataFrame, text: str = "text") -> DataFrame:
    """(article_id, sent, pos, subject, predicate, object, confidence) of every sentence with a triple. No shuffle.

    `pos` is the token index of the predicate inside its sentence, plus a running order over sentences is (sent, pos).
    """
    rows = articles.select("article_id", F.posexplode(tx.sentences(tx.filled(F.col(text)))).alias("sent", "sentence"))
    rows = rows.withColumn("_tokens", tx.word_tokens(F.col("sentence"))).drop("sentence")
    rows = rows.withColumn("_roles", an.roles(an.lowered(F.col("_tokens"))))
    rows = rows.withColumn("_a", an.anchor_at(F.col("_roles"))).where("_a > 0")
    rows = rows.withColumn("_s", an.subject_at(F.col("_roles"), F.col("_a")))
    rows = rows.withColumn("_o", an.object_at(F.col("_roles"), F.col("_a"))).where("_s > 0 and _o > 0")
    verb = an.lemma(F.lower(F.get("_tokens", F.col("_a") - 1)))
    distance = (F.col("_a") - F.col("_s")) + (F.col("_o") - F.col("_a"))
    return rows.select(
        "article_id", "sent", (F.col("_a") - 1).alias("pos"),
        F.get("_tokens", F.col("_s") - 1).alias("subject"),
        F.get("_tokens", F.col("_a") - 1).alias("predicate"),
        F.get("_tokens", F.col("_o") - 1).alias("object"),
        an.relation_confidence(distance, verb).alias("confidence"),
    )


def relations_of_tokens(tokens: DataFrame) -> DataFrame:
    """(article_id, sent, pos, subject, predicate, object, confidence) from a token table; `pos` is the root's `i`.

    The subject is the first left child of a ROOT with a subject dependency, the object the first right child with an
    object dependency. Root and children meet by grouping on the head index: one shuffle of the few tokens that
    matter, no self-join.
    """
    is_root = F.col("dep") == "ROOT"
    wanted = tokens.where(F.col("dep").isin(["ROOT", *lx.SUBJECT_DEPS, *lx.OBJECT_DEPS]))
    wanted = wanted.withColumn("root_i", F.when(is_root, F.col("i")).otherwise(F.col("head_i")))
    me = F.struct("i", "text")
    subject = F.when(F.col("dep").isin(lx.SUBJECT_DEPS) & (F.col("i") < F.col("root_i")), me)
    obj = F.when(F.col("dep").isin(lx.OBJECT_DEPS) & (F.col("i") > F.col("root_i")), me)
    triples = wanted.groupBy("article_id", "sent", "root_i").agg(
        F.max(F.when(is_root, F.struct("text", "lemma"))).alias("root"),
        F.min(subject).alias("subj"),
        F.min(obj).alias("obj"),
    ).where("root is not null and subj is not null and obj is not null")
    distance = F.abs(F.col("root_i") - F.col("subj.i")) + F.abs(F.col("root_i") - F.col("obj.i"))
    return triples.select(
        "article_id", "sent", F.col("root_i").alias("pos"), F.col("subj.text").alias("subject"),
        F.col("root.text").alias("predicate"), F.col("obj.text").alias("object"),
        an.relation_confidence(distance, F.col("root.lemma")).alias("confidence"),
    )


def confident(relations: DataFrame, threshold: float = lx.RELATION_THRESHOLD) -> DataFrame:
    """Relations with confidence >= threshold, compared as doubles."""
    return relations.where(F.col("confidence") >= F.lit(threshold))


def of_linked_articles(relations: DataFrame, linked: DataFrame) -> DataFrame:
    """Relations of the articles that have at least one linked entity."""
    return relations.join(linked.select("article_id").distinct(), "article_id", "left_semi")


def without_confidence(relations: DataFrame) -> DataFrame:
    """Relations as the catalogue-free variant gives them: no confidence, no threshold."""
    return relations.withColumn("confidence", F.lit(None).cast("double"))
