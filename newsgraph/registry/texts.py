"""Queries: projections, cleaning, tokenising, summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.functions import text as tx
from newsgraph.operators import summary as sm
from newsgraph.plans import articles as plan
from newsgraph.registry import oracle as o
from newsgraph.registry.inputs import all_turns, articles, gazetteer, labelled_events, longs, table, turns
from newsgraph.sources import readers as rd


def _documents(expression):
    def query(spark, sf_dir):
        return articles(spark, sf_dir).select("article_id", expression(F.col("text")).alias("value"))
    return query


def _doc_sql(expr):
    return o.sql(f"SELECT article_id, {expr} AS value FROM articles")


def null_text(spark, sf_dir):
    return turns(spark, sf_dir).select("article_id", tx.filled(F.col("Sentence")).alias("value"))


def triple_sentence(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("a"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("p"), F.col("props").alias("b"),
    )
    return rows.select("event_id", tx.filled(tx.sentence_of(F.col("a"), F.col("p"), F.col("b"))).alias("value"))


def raw_beside_clean(spark, sf_dir):
    return articles(spark, sf_dir).withColumn("cleaned", tx.clean(F.col("text"))).select("article_id", "text", "cleaned")


def article_records(spark, sf_dir):
    rows = articles(spark, sf_dir).withColumn("tokens", tx.clean_tokens(F.col("text")))
    return longs(rows.select("article_id", "url", tx.join_tokens(F.col("tokens")).alias("text"), F.size("tokens").alias("n_tokens")))


def header_names(spark, sf_dir):
    rows = labelled_events(spark, sf_dir).toDF(" ID", "Subject ", "RELATION", " Object")
    return rd.normalise_headers(rows)


def header_aliases(spark, sf_dir):
    rows = labelled_events(spark, sf_dir).toDF(" ID", "Head ", "RelationType", " Tail")
    return rd.alias_headers(rd.normalise_headers(rows))


def required_columns(spark, sf_dir):
    rows = labelled_events(spark, sf_dir)
    try:
        rd.require_columns(rows.drop("entity1", "entity2"), ["entity1", "predicate", "entity2"])
        message = ""
    except ValueError as error:
        message = str(error)
    checked = rd.require_columns(rows, ["entity1", "predicate", "entity2"])
    return checked.groupBy("predicate").agg(F.count(F.lit(1)).alias("n")).withColumn("message", F.lit(message))


def url_removal(spark, sf_dir):
    """Links inside the markup of pages."""
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), tx.strip_urls(F.col("html")).alias("value"))


def cleaned_pages(spark, sf_dir):
    """Markup is full of links, hyphens and entities."""
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), tx.clean(F.col("html")).alias("value"))


def token_counts(spark, sf_dir):
    """Tokens of the cleaned text, counted over all documents."""
    tokens = articles(spark, sf_dir).select(F.explode(tx.clean_tokens(F.col("text"))).alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def blank_tokens(spark, sf_dir):
    """Tokens of already cleaned text, split on white space."""
    return articles(spark, sf_dir).select("article_id", tx.join_tokens(tx.split_blank(tx.clean(F.col("text")))).alias("value"))


def word_tokens(spark, sf_dir):
    tokens = articles(spark, sf_dir).select(F.explode(tx.word_tokens(F.col("text"))).alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def sentence_rows(spark, sf_dir):
    rows = articles(spark, sf_dir).select("article_id", F.posexplode(tx.sentences(F.col("text"))).alias("sent", "sentence"))
    return longs(rows)


def comma_lists(spark, sf_dir):
    rows = articles(spark, sf_dir)
    return rows.select("article_id", tx.comma_list(tx.sentences(F.col("text"))).alias("value"))


def sentence_ranking(spark, sf_dir):
    rows = sm.ranked_sentences(articles(spark, sf_dir))
    return longs(rows.select("article_id", "sent", F.round("score", 6).alias("score")))


def best_sentence(spark, sf_dir):
    rows = articles(spark, sf_dir)
    return rows.select("article_id", F.coalesce(sm.best_sentence(F.col("text")), F.lit("")).alias("sentence"))


def summaries(spark, sf_dir):
    return sm.summarise(turns(spark, sf_dir), "Sentence").select("article_id", "summary")


def prepared_sentences(spark, sf_dir):
    rows = plan.prepare_sentences(all_turns(spark, sf_dir), gazetteer(spark, sf_dir))
    found = F.transform("mentions", lambda m: F.concat_ws("/", m["pos"].cast("string"), m["text"], m["label"]))
    return rows.select("article_id", F.col("Sentence").alias("sentence"), F.array_join(found, ";").alias("mentions"))


def prepared_articles(spark, sf_dir):
    rows = plan.prepare_articles(articles(spark, sf_dir), gazetteer(spark, sf_dir))
    found = F.transform("mentions", lambda m: F.concat_ws("/", m["pos"].cast("string"), m["text"], m["label"]))
    return longs(rows.select(
        "article_id", "url", "summary", "cleaned", F.size("tokens").alias("n_tokens"), F.array_join(found, ";").alias("mentions")
    ))


_TURN_SQL = "coalesce(\"Sentence\", '')"
_STOP_FILTERED = f"array_to_string(list_filter({o.tokens_of('lower(text)')}, lambda w: w NOT IN {o.STOP}), ' ')"
_MENTION_LIST = "string_agg(pos || '/' || text || '/' || label, ';' ORDER BY pos)"

o.CTES["clean_turns"] = f"SELECT article_id, {o.clean(_TURN_SQL)} AS sentence FROM all_turns"
o.CTES.update(o.mention_ctes("turn_", "clean_turns", "sentence", capitalised=False))
o.refresh()

QUERIES = {
    "prj1_null_text_filled": (null_text, o.sql(f"SELECT article_id, {_TURN_SQL} AS value FROM turns")),
    "prj2_triple_sentence": (triple_sentence, """
        SELECT event_id, coalesce(user_id::VARCHAR || ' ' || CASE WHEN event_type <> 'error' THEN event_type END
               || ' ' || props, '') AS value FROM events"""),
    "prj3_raw_beside_clean": (raw_beside_clean, o.sql(f"SELECT article_id, text, {o.clean('text')} AS cleaned FROM articles")),
    "prj4_article_records": (article_records, o.sql(f"""
        SELECT article_id, url, {o.clean('text')} AS text, len({o.clean_list('text')}) AS n_tokens FROM articles""")),
    "prj5_header_names": (header_names, o.sql("""
        SELECT id, entity1 AS subject, predicate AS relation, entity2 AS object FROM triples""")),
    "prj6_header_aliases": (header_aliases, o.sql("SELECT id, entity1, predicate, entity2 FROM triples")),
    "prj7_required_columns": (required_columns, """
        SELECT event_type AS predicate, count(*) AS n, 'missing required columns: entity1, entity2' AS message
        FROM events GROUP BY event_type"""),
    "txt1_urls": (url_removal, f"SELECT page_id AS id, {o.urls('html')} AS value FROM pages"),
    "txt2_special_characters": (_documents(tx.strip_special), _doc_sql(o.special("text"))),
    "txt3_hyphens": (_documents(tx.strip_hyphens), _doc_sql(o.hyphens("text"))),
    "txt4_digits": (_documents(tx.strip_digits), _doc_sql(o.digits("text"))),
    "txt5_lower": (_documents(F.lower), _doc_sql("lower(text)")),
    "txt6_stop_words": (
        _documents(lambda c: tx.join_tokens(tx.without_stop_words(tx.split_blank(F.lower(c))))), _doc_sql(_STOP_FILTERED)),
    "txt7_collapse_spaces": (_documents(tx.collapse_spaces), _doc_sql(f"array_to_string({o.tokens_of('text')}, ' ')")),
    "txt8_clean": (_documents(tx.clean), _doc_sql(o.clean("text"))),
    "txt8_clean_pages": (cleaned_pages, f"SELECT page_id AS id, {o.clean('html')} AS value FROM pages"),
    "txt9_token_counts": (token_counts, o.sql(f"""
        SELECT token, count(*) AS n FROM (SELECT unnest({o.clean_list('text')}) AS token FROM articles) GROUP BY token""")),
    "txt9_blank_tokens": (blank_tokens, _doc_sql(o.clean("text"))),
    "txt10_word_tokens": (word_tokens, o.sql(f"""
        SELECT token, count(*) AS n FROM (SELECT unnest({o.words_of('text')}) AS token FROM articles) GROUP BY token""")),
    "txt11_join_tokens": (_documents(lambda c: tx.join_tokens(tx.word_tokens(c))), _doc_sql(f"array_to_string({o.words_of('text')}, ' ')")),
    "txt12_sentences": (sentence_rows, o.sql("SELECT article_id, sent, sentence FROM sents")),
    "txt13_capped_tokens": (
        _documents(lambda c: tx.join_tokens(tx.capped_tokens(c))),
        _doc_sql(f"array_to_string(({o.tokens_of('text')})[1:{lx.MAX_CLASSIFIER_TOKENS}], ' ')")),
    "txt14_comma_list": (comma_lists, _doc_sql(f"array_to_string({o.sentences_of('text')}, ',')")),
    "sum1_sentence_scores": (sentence_ranking, o.sql(
        "SELECT article_id, sent, round(score, 6) AS score FROM sentence_scores")),
    "sum1_best_sentence": (best_sentence, o.sql("""
        SELECT a.article_id, coalesce(b.sentence, '') AS sentence
        FROM articles a LEFT JOIN best_sentences b ON b.article_id = a.article_id""")),
    "sum2_summary_or_text": (summaries, o.sql("""
        SELECT article_id, coalesce(best, original, '') AS summary FROM turn_best""")),
    "pip4_prepared_articles": (prepared_articles, o.sql(f"""
        SELECT s.article_id, s.url, s.summary, {o.clean('s.summary')} AS cleaned, len({o.clean_list('s.summary')}) AS n_tokens,
               coalesce(m.mentions, '') AS mentions
        FROM summaries s LEFT JOIN (SELECT article_id, {_MENTION_LIST} AS mentions FROM sum_mentions GROUP BY article_id) m
          ON m.article_id = s.article_id""")),
    "pip5_prepared_sentences": (prepared_sentences, o.sql(f"""
        SELECT t.article_id, t.sentence, coalesce(m.mentions, '') AS mentions
        FROM clean_turns t LEFT JOIN (SELECT article_id, {_MENTION_LIST} AS mentions FROM turn_mentions GROUP BY article_id) m
          ON m.article_id = t.article_id""")),
}
