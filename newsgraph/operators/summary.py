"""Extractive summary: the best sentence of a text by latent-semantic ranking.

With every singular dimension kept, the rank of sentence j is the squared norm of column j of the weighted
term-by-sentence matrix, so no decomposition is needed. A sentence's weight for a term with count c is
0.4 + 0.6 * c / m, where m is the sentence's highest count; 0.4 is shared by all cells. Summed over its distinct
terms the part above the shared constant is 0.48 * n / m + 0.36 * q / m^2, where n is the number of words and q the
sum of squared counts. n, m and q come from one pass over the sorted words, so the whole operator is a projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.functions import text as tx


def sentence_score(sentence: Column) -> Column:
    """Score of one sentence from its own words; 0 for a sentence without words."""
    words = F.sort_array(F.regexp_extract_all(F.lower(sentence), F.lit(lx.SUMMARY_WORD), F.lit(0)))
    start = F.struct(
        F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0).alias("n"), F.lit(0).alias("m"),
        F.lit(0).cast("long").alias("q"),
    )

    def step(state: Column, word: Column) -> Column:
        run = F.when(state["word"] == word, state["run"] + 1).otherwise(1)
        return F.struct(
            word.alias("word"),
            run.alias("run"),
            (state["n"] + 1).alias("n"),
            F.greatest(state["m"], run).alias("m"),
            # squares grow by successive odd numbers
            (state["q"] + 2 * run - 1).cast("long").alias("q"),
        )

    def finish(state: Column) -> Column:
        m = state["m"].cast("double")
        score = F.lit(0.48) * state["n"] / m + F.lit(0.36) * state["q"] / (m * m)
        return F.when(state["m"] == 0, F.lit(0.0)).otherwise(F.round(score, 9))

    return F.aggregate(words, start, step, finish)


def ranked_sentences(articles: DataFrame, text: str = "text") -> DataFrame:
    """One row per sentence with its position and score. No shuffle."""
    rows = articles.select("article_id", F.posexplode(tx.sentences(tx.filled(F.col(text)))).alias("sent", "sentence"))
    return rows.withColumn("score", sentence_score(F.col("sentence")))


def best_sentence(text: Column) -> Column:
    """The highest-scored sentence, the earliest on ties; null for a text without sentences."""
    scored = F.transform(
        tx.sentences(text), lambda s, i: F.struct(sentence_score(s).alias("score"), (-i).alias("order"), s.alias("sentence"))
    )
    return F.array_max(scored)["sentence"]


def summarise(articles: DataFrame, text: str = "text", into: str = "summary", keep: int = 1) -> DataFrame:
    """Add the best `keep` sentences, in text order; a text without a sentence keeps itself. No shuffle."""
    filled = tx.filled(F.col(text))
    if keep == 1:
        return articles.withColumn(into, F.coalesce(best_sentence(filled), filled))
    scored = F.transform(
        tx.sentences(filled),
        lambda s, i: F.struct((-sentence_score(s)).alias("score"), i.alias("sent"), s.alias("sentence")),
    )
    best = F.slice(F.sort_array(scored), 1, keep)
    in_order = F.sort_array(F.transform(best, lambda b: F.struct(b["sent"].alias("sent"), b["sentence"].alias("sentence"))))
    joined = F.array_join(F.transform(in_order, lambda b: b["sentence"]), " ")
    return articles.withColumn(into, F.when(F.size(in_order) > 0, joined).otherwise(filled))
