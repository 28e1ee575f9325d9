"""Queries: features, TF-IDF, splits, labels, classifier."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from newsgraph.functions import vectors as vx
from newsgraph.functions.text import terms
from newsgraph.operators import classify as cl
from newsgraph.operators import features as ft
from newsgraph.operators import naive_bayes as nb
from newsgraph.operators import relations as rl
from newsgraph.operators import splits as sp
from newsgraph.operators import svd as sv
from newsgraph.operators import tfidf as ti
from newsgraph.plans import triples as plan
from newsgraph.plans.articles import article_features
from newsgraph.registry import found as fd
from newsgraph.registry import oracle as o
from newsgraph.registry.inputs import articles, labelled_events, longs, table, vectors
from newsgraph.scratch import fresh_path, materialise


def vectoriser_terms(spark, sf_dir):
    rows = articles(spark, sf_dir).select(F.explode(terms(F.col("text"))).alias("term"))
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def term_counts(spark, sf_dir):
    return longs(ti.term_counts(articles(spark, sf_dir)))


def smoothed_idf(spark, sf_dir):
    docs = articles(spark, sf_dir)
    rows = ti.smoothed_idf(ti.document_frequency(ti.term_counts(docs)), docs)
    return rows.withColumn("idf", F.round("idf", 6))


def weights(spark, sf_dir):
    return ti.tfidf(articles(spark, sf_dir)).select("article_id", "term", F.round("w", 6).alias("w"))


def svd_components(spark, sf_dir):
    """Scores of the first 100 components (fewer if there are fewer articles)."""
    scores, _ = sv.truncated_svd(ti.tfidf(articles(spark, sf_dir)), last_use=True)
    return ft.spread_components(scores)


SVD_GROUPS = 80


def svd_products(spark, sf_dir):
    """Documents in 80 groups, decomposed in full: the scores' products must be those of the groups' own rows."""
    counts = ti.term_counts(articles(spark, sf_dir)).withColumn("article_id", F.col("article_id") % SVD_GROUPS)
    rows = materialise(counts.groupBy("article_id", "term").agg(F.log(1 + F.sum("tf").cast("double")).alias("raw")), "group-terms")
    norms = rows.groupBy("article_id").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    df = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = rows.join(df, "term").join(F.broadcast(norms), "article_id").select("article_id", "term", "df", (F.col("raw") / F.col("norm")).alias("w"))
    scores, _ = sv.truncated_svd(weights, SVD_GROUPS)
    scores = materialise(scores, "scores")  # 80 rows
    left, right = scores.select(F.col("article_id").alias("a"), F.col("components").alias("x")), scores.select(F.col("article_id").alias("b"), F.col("components").alias("y"))
    product = F.aggregate(F.zip_with("x", "y", lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    products = left.join(F.broadcast(right), F.col("a") <= F.col("b")).select("a", "b", (F.round(product, 4) + 0.0).alias("product"))
    return products.join(F.broadcast(_groups_with_a_common_term(weights)), ["a", "b"], "left_semi")


def _groups_with_a_common_term(weights):
    """(a, b), a <= b, of groups that share a term. Groups are marks in four numbers, so a term costs a row for each group it
    is in, and a group one row in all; the remainder of a negative id is negative."""
    numbers, bits = range(4), SVD_GROUPS // 2

    def mark(group, k):
        place = group + (SVD_GROUPS - k * bits)
        return F.when(place.between(0, bits - 1), F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))).otherwise(F.lit(0).cast("long"))

    of_term = weights.groupBy("term").agg(*[F.bit_or(mark(F.col("article_id"), k)).alias(f"m{k}") for k in numbers], F.collect_set("article_id").alias("groups"))
    of_group = of_term.select(F.explode("groups").alias("a"), *[f"m{k}" for k in numbers]).groupBy("a").agg(*[F.bit_or(f"m{k}").alias(f"m{k}") for k in numbers])
    pairs = of_group.withColumn("b", F.explode(F.sequence("a", F.lit(SVD_GROUPS - 1).cast("long"))))
    shared = reduce(or_, [F.col(f"m{k}").bitwiseAND(mark(F.col("b"), k)) != 0 for k in numbers])
    return pairs.where(shared).select("a", "b")


def entity_features(spark, sf_dir):
    rows = ft.entity_features(articles(spark, sf_dir), fd.found(spark, sf_dir))
    return _six(rows, "entity_density", "person_ratio", "org_ratio")


def _six(rows, *columns):
    for name in columns:
        rows = rows.withColumn(name, F.round(name, 6))
    return longs(rows)


_RATIOS = ("avg_word_length", "stopwords_ratio", "punct_ratio", "avg_sentence_length")


def statistical_features(spark, sf_dir):
    return _six(ft.statistical_features(articles(spark, sf_dir)), *_RATIOS)


def statistical_features_of_tokens(spark, sf_dir):
    docs = articles(spark, sf_dir)
    return _six(ft.statistical_features_of_tokens(docs, rl.annotate(docs)), *_RATIOS)


def unit_vectors(spark, sf_dir):
    rows = vectors(spark, sf_dir).withColumn("n", vx.norm(F.col("embedding")))
    rows = rows.withColumn("u", vx.unit(F.col("embedding"), F.col("n")))
    return rows.select("article_id", F.array_join(F.transform("u", lambda x: F.round(x * 1e6).cast("long").cast("string")), ",").alias("unit"))


def embedding_features(spark, sf_dir):
    return _six(ft.embedding_features(vectors(spark, sf_dir)), "embedding_mean", "embedding_std", "embedding_norm")


def feature_table(spark, sf_dir):
    docs = articles(spark, sf_dir)
    rows = article_features(docs, fd.found(spark, sf_dir), vectors(spark, sf_dir), "text", None, True)
    return _six(rows, "entity_density", "person_ratio", "org_ratio", *_RATIOS, "embedding_mean", "embedding_std", "embedding_norm")


def whole_table(spark, sf_dir):
    """All 126 columns of the feature table, TF-IDF components included."""
    docs = articles(spark, sf_dir)
    return article_features(docs, fd.found(spark, sf_dir), vectors(spark, sf_dir), "text", sv.lx.SVD_COMPONENTS, True)


def with_component_count(rows):
    """The columns that SQL can compute, and how many components a row has."""
    components = [c for c in rows.columns if c.startswith("tfidf_comp_")]
    given = sum((F.when(F.col(c).isNotNull() & ~F.isnan(c), 1).otherwise(0) for c in components), F.lit(0))
    rows = rows.withColumn("n_components", given).drop(*components)
    return _six(rows, "entity_density", "person_ratio", "org_ratio", *_RATIOS, "embedding_mean", "embedding_std", "embedding_norm")


def whole_feature_table(spark, sf_dir):
    """The components themselves are checked by tfi5_svd_products."""
    return with_component_count(whole_table(spark, sf_dir))


def kept_triples(spark, sf_dir):
    return sp.drop_rare_classes(sp.drop_missing(labelled_events(spark, sf_dir)))


def missing_dropped(spark, sf_dir):
    rows = labelled_events(spark, sf_dir).withColumn("entity1", F.when(F.col("predicate") != "view", F.col("entity1")))
    return sp.drop_missing(rows)


def nonempty(spark, sf_dir):
    return sp.class_counts(sp.require_rows(kept_triples(spark, sf_dir)))


def class_counts(spark, sf_dir):
    return sp.class_counts(sp.drop_missing(labelled_events(spark, sf_dir)))


def _document_triples(spark, sf_dir):
    """Relations of the documents; the object as class gives many classes of one row. Staged: the splits read them often."""
    rows = materialise(rl.relations_of_text(articles(spark, sf_dir)), "document-relations")
    return rows.select("article_id", "sent", F.col("subject").alias("entity1"), F.col("object").alias("predicate"), F.col("predicate").alias("entity2"))


def rare_dropped(spark, sf_dir):
    return longs(sp.drop_rare_classes(_document_triples(spark, sf_dir)))


def stratified(spark, sf_dir):
    return sp.stratified_split(kept_triples(spark, sf_dir))


def random_split(spark, sf_dir):
    return sp.random_split(kept_triples(spark, sf_dir)).select("id", "split")


def fallback_split(spark, sf_dir):
    """Classes of two rows cannot be stratified, so the plain split must be chosen."""
    rows = sp.drop_rare_classes(_document_triples(spark, sf_dir)).withColumn("id", F.concat_ws("-", "article_id", "sent"))
    return sp.split(materialise(rows, "kept-triples")).select("id", "split")


def small_train(spark, sf_dir):
    train = sp.stratified_split(kept_triples(spark, sf_dir)).where("split = 'train'").drop("split")
    return sp.sample_fraction(train)


def label_codes(spark, sf_dir):
    return longs(sp.label_codes(sp.stratified_split(kept_triples(spark, sf_dir)).where("split = 'train'")))


def encoded(spark, sf_dir):
    splits = sp.stratified_split(kept_triples(spark, sf_dir))
    codes = sp.label_codes(splits.where("split = 'train'"))
    return longs(sp.encode_labels(splits.where("split <> 'test'"), codes).select("id", "split", "predicate", "code"))


def prepared_triples(spark, sf_dir):
    rows = labelled_events(spark, sf_dir).toDF("id", " Head", "Relation", "TAIL ")
    splits = plan.with_small_train(plan.prepare_triples(rows, "id"))
    return splits.groupBy("split", "predicate").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


def _quality_splits(spark, sf_dir):
    """The quality label as predicate, with the document as entity1."""
    rows = articles(spark, sf_dir).join(table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "article_id"), "article_id")
    rows = rows.select(
        F.col("article_id").alias("id"), F.col("text").alias("entity1"),
        F.when(F.col("quality") == 1, "good").otherwise("bad").alias("predicate"), F.lit("").alias("entity2"),
    )
    return sp.stratified_split(rows)


def _model(spark, sf_dir):
    """A classifier of the quality label."""
    splits = _quality_splits(spark, sf_dir)
    return splits, cl.train(splits.where("split = 'train'"))


def _table_predictions(spark, sf_dir):
    """The rows outside of train with the class that a table model gives them."""
    splits = materialise(_quality_splits(spark, sf_dir), "quality-splits")
    return nb.predict(nb.train(splits.where("split = 'train'")), splits.where("split <> 'train'"))


def table_predictions(spark, sf_dir):
    return _table_predictions(spark, sf_dir).select("id", "split", "predicted")


def table_confusion(spark, sf_dir):
    return cl.confusion(_table_predictions(spark, sf_dir))


def table_scores(spark, sf_dir):
    return nb.scores(cl.confusion(_table_predictions(spark, sf_dir))).withColumn("value", F.round("value", 9))


def table_model(spark, sf_dir):
    """The model's tables after saving and loading."""
    path = fresh_path(spark, "table-model")
    nb.write_model(nb.train(_quality_splits(spark, sf_dir).where("split = 'train'")), path)
    model = nb.read_model(spark, path)
    none = F.lit(None).cast("long")
    return model.terms.select("predicate", "term", "gain", none.alias("prior"), none.alias("share")).union(
        model.classes.select("predicate", F.lit(None).cast("string"), none, "prior", "share"))


def trained_and_scored(spark, sf_dir):
    """Prepare, train on the small sample, save, load, score valid."""
    rows = labelled_events(spark, sf_dir).toDF("id", " Head", "Relation", "TAIL ")
    splits = materialise(plan.with_small_train(plan.prepare_triples(rows, "id")), "splits")
    return plan.train_and_score(splits, fresh_path(spark, "relation-model"))["predictions"].select("id", "predicate", "predicted")


def classifier_scores(spark, sf_dir):
    splits, model = _model(spark, sf_dir)
    scores = cl.evaluate(model, splits.where("split = 'valid'"))
    return spark.createDataFrame(list(scores.items()), "metric string, value double")


def classifier_confusion(spark, sf_dir):
    splits, model = _model(spark, sf_dir)
    return cl.confusion(cl.predict(model, splits.where("split <> 'train'")))


def classifier_predictions(spark, sf_dir):
    splits, model = _model(spark, sf_dir)
    return cl.predict(model, splits.drop("predicate")).select("id", "predicted")


o.CTES["quality_split"] = """
    SELECT id, entity1, predicate, CASE WHEN r <= m - h THEN 'train' WHEN r <= m - (h + 1) // 2 THEN 'valid' ELSE 'test' END AS split
    FROM (SELECT *, (2 * m + 5) // 10 AS h FROM (
        SELECT *, row_number() OVER (PARTITION BY predicate ORDER BY md5(concat_ws('|', '42', id::VARCHAR)), id) AS r,
               count(*) OVER (PARTITION BY predicate) AS m
        FROM (SELECT a.article_id AS id, a.text AS entity1, CASE WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS predicate
              FROM articles a JOIN labels l ON l.doc_id = a.article_id)))"""


def _bayes(name, rows, train, score):
    """Every class for every row, as the definition has it."""
    words = f"SELECT id, predicate, unnest(({o.tokens_of('lower(entity1)')})[1:{o.lx.MAX_CLASSIFIER_TOKENS}]) AS term FROM ({rows})"
    o.CTES[f"{name}_counts"] = f"SELECT predicate, term, count(*) AS n FROM ({words} WHERE {train}) GROUP BY predicate, term"
    o.CTES[f"{name}_classes"] = f"""
        SELECT c.predicate, round(ln(c.n / sum(c.n) OVER ()) * 1000000)::BIGINT AS prior,
               round(ln((coalesce(t.tokens, 0) + (SELECT count(DISTINCT term) FROM {name}_counts))::DOUBLE) * 1000000)::BIGINT AS share
        FROM (SELECT predicate, count(*) AS n FROM ({rows}) WHERE ({train}) AND entity1 IS NOT NULL GROUP BY predicate) c
        LEFT JOIN (SELECT predicate, sum(n) AS tokens FROM {name}_counts GROUP BY predicate) t ON t.predicate = c.predicate"""
    o.CTES[f"{name}_predictions"] = f"""
        SELECT id, predicate, predicted FROM (
            SELECT r.id, r.predicate, c.predicate AS predicted, row_number() OVER (PARTITION BY r.id ORDER BY
                   c.prior - coalesce(w.known, 0) * c.share + coalesce(g.gain, 0) DESC, c.predicate) AS rn
            FROM (SELECT * FROM ({rows}) WHERE {score}) r CROSS JOIN {name}_classes c
            LEFT JOIN (SELECT id, count(*) AS known FROM ({words} WHERE {score}) WHERE term IN (SELECT term FROM {name}_counts) GROUP BY id) w
                   ON w.id = r.id
            LEFT JOIN (SELECT s.id, k.predicate, sum(round(ln(k.n + 1.0::DOUBLE) * 1000000)::BIGINT) AS gain
                       FROM ({words} WHERE {score}) s JOIN {name}_counts k ON k.term = s.term GROUP BY s.id, k.predicate) g
                   ON g.id = r.id AND g.predicate = c.predicate)
        WHERE rn = 1"""


_bayes("quality", "SELECT * FROM quality_split", "split = 'train'", "split <> 'train'")
_bayes("relation", """
    SELECT id, entity1, predicate, split FROM split_triples
    UNION ALL SELECT id, entity1, predicate, 'train_small' FROM small_train""", "split = 'train_small'", "split = 'valid'")
o.refresh()

o.CTES["grouped_weights"] = f"""
    SELECT g, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY g)) AS w FROM (
        SELECT article_id % {SVD_GROUPS} AS g, term, ln(1 + sum(tf)::DOUBLE) AS raw FROM term_counts GROUP BY article_id % {SVD_GROUPS}, term)"""
o.refresh()

_ENTITY_FEATURES = """
    SELECT a.article_id, coalesce(n, 0) AS num_entities, coalesce(per, 0) AS num_persons, coalesce(org, 0) AS num_orgs,
           coalesce(mon, 0) AS num_money, coalesce(dat, 0) AS num_dates, coalesce(loc, 0) AS num_locations,
           coalesce(ev, 0) AS num_events, coalesce(k, 0) AS unique_entity_types,
           coalesce(round(n::DOUBLE / nullif(t.tokens, 0), 6), 0) AS entity_density,
           coalesce(round(per::DOUBLE / nullif(n, 0), 6), 0) AS person_ratio,
           coalesce(round(org::DOUBLE / nullif(n, 0), 6), 0) AS org_ratio
    FROM articles a
    LEFT JOIN (SELECT article_id, count(*) AS n, count(*) FILTER (label = 'PERSON') AS per,
                      count(*) FILTER (label = 'ORG') AS org, count(*) FILTER (label = 'MONEY') AS mon,
                      count(*) FILTER (label = 'DATE') AS dat, count(*) FILTER (label IN ('GPE', 'LOC')) AS loc,
                      count(*) FILTER (label = 'EVENT') AS ev, count(DISTINCT label) AS k
               FROM doc_mentions GROUP BY article_id) m ON m.article_id = a.article_id
    LEFT JOIN (SELECT article_id, count(*) AS tokens FROM word_rows GROUP BY article_id) t ON t.article_id = a.article_id"""
_STATISTICS = """
    SELECT a.article_id, length(a.text) AS text_length, coalesce(t.sentences, 0) AS num_sentences,
           coalesce(round(t.letters::DOUBLE / t.n, 6), 0) AS avg_word_length, coalesce(t.n, 0) AS num_tokens,
           coalesce(t.uniq, 0) AS unique_words, coalesce(round(t.stops::DOUBLE / t.n, 6), 0) AS stopwords_ratio,
           coalesce(round(t.marks::DOUBLE / t.n, 6), 0) AS punct_ratio, coalesce(t.chunks, 0) AS noun_phrases,
           coalesce(t.verbs, 0) AS verb_count, coalesce(t.nouns, 0) AS noun_count, coalesce(t.adjs, 0) AS adj_count,
           coalesce(round(t.n::DOUBLE / t.sentences, 6), 0) AS avg_sentence_length
    FROM articles a LEFT JOIN (
        SELECT article_id, count(*) AS n, count(DISTINCT sent) AS sentences, sum(length(text)) AS letters,
               count(DISTINCT lower(text)) FILTER (NOT is_punct) AS uniq, count(*) FILTER (is_stop) AS stops,
               count(*) FILTER (is_punct) AS marks, count(*) FILTER (pos = 'NOUN' AND before <> 'NOUN') AS chunks,
               count(*) FILTER (pos = 'VERB') AS verbs, count(*) FILTER (pos = 'NOUN') AS nouns,
               count(*) FILTER (pos = 'ADJ') AS adjs
        FROM (SELECT *, coalesce(lag(pos) OVER (PARTITION BY article_id, sent ORDER BY i), '') AS before FROM tokens)
        GROUP BY article_id) t ON t.article_id = a.article_id"""
_EMBEDDINGS = """
    SELECT vec_id AS article_id, round(avg(x / nullif(n, 0)), 6) AS embedding_mean,
           round(stddev_pop(x / nullif(n, 0)), 6) AS embedding_std, round(any_value(n), 6) AS embedding_norm
    FROM (SELECT vec_id, x, sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS n
          FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings)) GROUP BY vec_id"""
_TRIPLES = """
    SELECT article_id, sent, subject AS entity1, object AS predicate, predicate AS entity2 FROM all_relations"""
_KEPT = f"SELECT * FROM ({_TRIPLES}) WHERE predicate IN (SELECT object FROM all_relations GROUP BY object HAVING count(*) > 1)"

FEATURE_TABLE = f"""
    SELECT e.*, s.* EXCLUDE (article_id), coalesce(v.embedding_mean, 0) AS embedding_mean,
           coalesce(v.embedding_std, 0) AS embedding_std, coalesce(v.embedding_norm, 0) AS embedding_norm
    FROM ({_ENTITY_FEATURES}) e JOIN ({_STATISTICS}) s ON s.article_id = e.article_id
    LEFT JOIN ({_EMBEDDINGS}) v ON v.article_id = e.article_id"""

QUERIES = {
    "tfi1_terms": (vectoriser_terms, o.sql("SELECT term, sum(tf)::BIGINT AS n FROM term_counts GROUP BY term")),
    "tfi2_term_counts": (term_counts, o.sql("SELECT article_id, term, tf FROM term_counts")),
    "tfi3_smoothed_idf": (smoothed_idf, o.sql("SELECT term, df, round(idf, 6) AS idf FROM idf")),
    "tfi4_weights": (weights, o.sql("SELECT article_id, term, round(w, 6) AS w FROM weights")),
    "tfi5_svd_components": (svd_components, None),
    "tfi5_svd_products": (svd_products, o.sql(f"""
        SELECT x.g AS a, y.g AS b, round(sum(x.w * y.w), 4) AS product
        FROM grouped_weights x JOIN grouped_weights y ON x.term = y.term AND x.g <= y.g GROUP BY x.g, y.g""")),
    "enf_entity_features": (entity_features, o.sql(_ENTITY_FEATURES)),
    "stf_statistical_features": (statistical_features, o.sql(_STATISTICS)),
    "stf_statistical_features_of_tokens": (statistical_features_of_tokens, o.sql(_STATISTICS)),
    "emf1_unit_vectors": (unit_vectors, """
        SELECT vec_id AS article_id, string_agg(round(x / n * 1e6)::BIGINT::VARCHAR, ',' ORDER BY i) AS unit
        FROM (SELECT vec_id, i, x, sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS n
              FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings))
        GROUP BY vec_id"""),
    "emf_embedding_features": (embedding_features, _EMBEDDINGS),
    "cmb1_feature_table": (feature_table, o.sql(FEATURE_TABLE)),
    "cmb1_whole_table": (whole_feature_table, o.sql(f"SELECT *, {sv.lx.SVD_COMPONENTS} AS n_components FROM ({FEATURE_TABLE})")),
    "flt1_missing_dropped": (missing_dropped, o.sql("SELECT id, entity1, predicate, entity2 FROM triples WHERE predicate <> 'view'")),
    "flt4_nonempty": (nonempty, o.sql("SELECT predicate, count(*) AS n FROM kept_triples GROUP BY predicate")),
    "agg14_class_counts": (class_counts, o.sql("SELECT predicate, count(*) AS n FROM triples GROUP BY predicate")),
    "agg15_rare_classes_dropped": (rare_dropped, o.sql(_KEPT)),
    "spl1_stratified_split": (stratified, o.sql("SELECT id, entity1, predicate, entity2, split FROM split_triples")),
    "spl2_random_split": (random_split, o.sql("SELECT id, split FROM random_triples")),
    "spl2_fallback_split": (fallback_split, o.sql(f"""
        SELECT id, CASE WHEN r <= m - h THEN 'train' WHEN r <= m - (h + 1) // 2 THEN 'valid' ELSE 'test' END AS split
        FROM (SELECT *, (2 * m + 9) // 10 AS h FROM (
            SELECT id, row_number() OVER (ORDER BY md5(concat_ws('|', '42', id)), id) AS r, count(*) OVER () AS m
            FROM (SELECT article_id || '-' || sent AS id FROM ({_KEPT}))))""")),
    "spl3_small_train": (small_train, o.sql("SELECT id, entity1, predicate, entity2 FROM small_train")),
    "lbl1_label_codes": (label_codes, o.sql("SELECT predicate, code FROM label_codes")),
    "lbl2_encoded_labels": (encoded, o.sql("""
        SELECT t.id, t.split, t.predicate, c.code FROM split_triples t JOIN label_codes c ON c.predicate = t.predicate
        WHERE t.split <> 'test'""")),
    "pip3_prepared_triples": (prepared_triples, o.sql("""
        SELECT split, predicate, count(*) AS n, sum(id)::BIGINT AS ids FROM (
            SELECT split, predicate, id FROM split_triples UNION ALL SELECT 'train_small', predicate, id FROM small_train)
        GROUP BY split, predicate""")),
    "cls1_table_predictions": (table_predictions, o.sql("""
        SELECT p.id, s.split, p.predicted FROM quality_predictions p JOIN quality_split s ON s.id = p.id""")),
    "cls2_table_scores": (table_scores, o.sql("""
        WITH told AS (SELECT predicate AS name, count(*) AS told, count(*) FILTER (predicate = predicted) AS hits
                      FROM quality_predictions GROUP BY predicate),
             said AS (SELECT predicted AS name, count(*) AS said FROM quality_predictions GROUP BY predicted)
        SELECT 'accuracy' AS metric, round(sum(hits) / sum(told), 9) AS value FROM told
        UNION ALL SELECT 'f1', round(sum(2.0::DOUBLE * hits / (told + coalesce(said, 0)) * told) / sum(told), 9)
        FROM told LEFT JOIN said USING (name)""").replace("\n\n        WITH told", ",\n        told").replace("\n        WITH told", ",\n        told")),
    "cls3_table_confusion": (table_confusion, o.sql(
        "SELECT predicate, predicted, count(*) AS n FROM quality_predictions GROUP BY predicate, predicted")),
    "snk8_table_model": (table_model, o.sql("""
        SELECT predicate, term, round(ln(n + 1.0::DOUBLE) * 1000000)::BIGINT AS gain, NULL::BIGINT AS prior, NULL::BIGINT AS share
        FROM quality_counts UNION ALL SELECT predicate, NULL, NULL, prior, share FROM quality_classes""")),
    "pip3_trained_and_scored": (trained_and_scored, o.sql("SELECT id, predicate, predicted FROM relation_predictions")),
    "cls1_predictions": (classifier_predictions, None),
    "cls2_scores": (classifier_scores, None),
    "cls3_confusion": (classifier_confusion, None),
}
