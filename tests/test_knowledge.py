import pytest
from pyspark.sql import functions as F

from newsgraph.operators import knowledge as kb
from newsgraph.streaming import kb as stream

LINKED = [  # article_id, ord, pos, text, type, uri, confidence, article_url
    (1, 1, 0, "Acme", "ORG", "Q1", 0.6, "u1"), (1, 1, 5, "Acme", "ORG", "Q0", 0.8, "u1"),
    (2, 2, 0, "Acme Corp", "ORG", "Q1", 0.9, "u2"), (3, 3, 0, "Acme", "ORG", "A8", 1.0, "u3"),
    (3, 3, 1, "Acme", "PERSON", "", 0.5, "u3"), (3, 3, 2, "5%", "PERCENT", "", 0.5, "u3"), (4, 4, 0, "x", "ALIEN", "", 0.7, "u4"),
]
RELATIONS = [  # article_id, ord, sent, pos, subject, predicate, object, confidence, article_url
    (1, 1, 0, 3, "Acme", "owns", "Bob", 0.6, "u1"), (2, 2, 0, 1, "Acme", "sold", "Bob", 0.4, "u2"),
    (1, 1, 2, 0, "Acme", "led", "Bob", 0.7, "u1"), (2, 2, 1, 1, "Bob", "is", "Bob", None, "u2"), (2, 2, 2, 1, "Q1", "has", "Z", 0.5, None),
]


@pytest.fixture
def linked(spark):
    return spark.createDataFrame(LINKED, "article_id long, ord long, pos int, text string, type string, uri string, confidence double, article_url string")


@pytest.fixture
def relations(spark):
    return spark.createDataFrame(RELATIONS, "article_id long, ord long, sent int, pos int, subject string, predicate string, object string, confidence double, article_url string")


# what one upsert after the other leaves: uri of the first arrival, mean confidence, number, articles in order
ENTITIES = {
    ("ORG", "Acme"): ("Q1", 0.8, 3, ["u1", "u1", "u3"]), ("ORG", "Acme Corp"): ("Q1", 0.9, 1, ["u2"]),
    ("PERSON", "Acme"): ("", 0.5, 1, ["u3"]), ("PERCENT", "5%"): ("", 0.5, 1, ["u3"]), ("ALIEN", "x"): ("", 0.7, 1, ["u4"]),
}
NODES = {
    "Q1": ("ORG", "Acme Corp", "u2", 0.9), "PERSON_Acme": ("PERSON", "Acme", "u3", 0.5),
    "PERCENT_5%": ("PERCENT", "5%", "u3", 0.5), "ALIEN_x": ("ALIEN", "x", "u4", 0.7),
}


def test_entities(linked):
    got = {(r["type"], r["text"]): (r["uri"], round(r["confidence"], 9), r["confidence_counts"]) for r in kb.entities(linked).collect()}
    assert got == {k: v[:3] for k, v in ENTITIES.items()}


def test_categories(linked):
    got = {r["type"]: r["category"] for r in kb.entities(linked).collect()}
    assert got == {"ORG": "entities", "PERSON": "entities", "PERCENT": "attributes", "ALIEN": "attributes"}


@pytest.mark.parametrize("span", [1, 2, 1024])
def test_mention_lists_keep_duplicates_in_order(linked, span):
    lists = {}
    for r in kb.mention_lists(linked, span).orderBy("part").collect():
        lists.setdefault((r["type"], r["text"]), []).extend(r["mentions"])
    assert lists == {k: v[3] for k, v in ENTITIES.items()}


def test_later_first_arrival_overwrites_a_shared_node(linked):
    got = {r["node_id"]: (r["type"], r["text"], r["article_url"], r["confidence"]) for r in kb.nodes(linked).collect()}
    assert got == NODES
    shown = kb.node_articles(kb.nodes(linked)).where("node_id = 'Q1'").first()
    assert shown["articles"] == {"u2": 0.9} and shown["mentions"] == 1


def test_last_edge_wins(relations, rows):
    assert rows(kb.edges(relations)) == [
        ("Acme", "Bob", "sold", 0.4, "u2"), ("Bob", "Bob", "is", 0.5, "u2"), ("Q1", "Z", "has", 0.5, None)]


def test_endpoints_without_node(linked, relations, rows):
    nodes, edges = kb.nodes(linked), kb.edges(relations)
    assert rows(kb.endpoint_nodes(edges, nodes)) == [("Acme",), ("Bob",), ("Z",)]
    assert kb.all_nodes(nodes, edges).count() == nodes.count() + 3


def test_article_results_and_counts(spark, linked, relations, rows):
    articles = spark.createDataFrame([(i, f"u{i}") for i in range(1, 6)], "article_id long, url string")
    mentions = linked.unionByName(linked.where("article_id = 1"))
    results = kb.article_results(articles, mentions, linked, relations)
    meta = {r["article_id"]: tuple(r["metadata"]) for r in results.collect()}
    assert meta == {1: (4, 2, 2), 2: (1, 1, 3), 3: (3, 3, 0), 4: (1, 1, 0), 5: (0, 0, 0)}
    counted = {r[0]: tuple(r)[1:] for r in kb.article_counts(articles, mentions, linked, relations).collect()}
    assert counted == meta
    assert tuple(kb.corpus_totals(results).first()) == (7, 5)
    assert kb.flatten_relations(results).count() == 5


def _tables(base):
    return {name: sorted(map(repr, df.collect())) for name, df in base.items()}


def _lists(base):
    lists = {}
    for r in base["mention_lists"].orderBy("part").collect():
        lists.setdefault((r["type"], r["text"]), []).extend(r["mentions"])
    return lists


def _whole(linked, relations):
    return {"entities": kb.entities(linked), "edges": kb.edges(relations), "nodes": kb.all_nodes(kb.nodes(linked), kb.edges(relations))}


def _same(base, linked, relations):
    rounded = lambda t: t | {"entities": t["entities"].withColumn("confidence", F.round("confidence", 12))}
    got = _tables(rounded({name: base[name] for name in ("entities", "edges", "nodes")}))
    assert got == _tables(rounded(_whole(linked, relations)))


def test_batches_merge_to_the_whole(spark, linked, relations, tmp_path):
    path = str(tmp_path / "kb")
    for number, (low, high) in enumerate([(3, 9), (1, 1), (2, 2)]):
        taken = [stream.append_batch(linked.where(F.col("ord").between(low, high)), relations.where(F.col("ord").between(low, high)), path, number)
                 for _ in range(2)]
        assert taken == [True, False]  # a retried batch counts once
    for _ in range(2):
        base = stream.read_knowledge_base(spark, path)
        _same(base, linked, relations)
        assert _lists(base) == {k: v[3] for k, v in ENTITIES.items()}
        assert stream.compact(spark, path) == 2
    assert stream.vacuum(spark, path) == 3
    _same(stream.read_knowledge_base(spark, path), linked, relations)


def test_a_batch_that_dies_between_its_writes_does_not_count(spark, linked, relations, tmp_path, monkeypatch):
    path = str(tmp_path / "kb")
    first, second = F.col("ord") <= 2, F.col("ord") > 2
    stream.append_batch(linked.where(first), relations.where(first), path, 0)
    before = _tables(stream.read_knowledge_base(spark, path))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(stream, "_mark", dies)
        with pytest.raises(OSError):
            stream.append_batch(linked.where(second), relations.where(second), path, 1)
    with monkeypatch.context() as patch:
        patch.setattr(stream, "edge_delta", dies)  # before the second and third write
        with pytest.raises(OSError):
            stream.append_batch(linked.where(second), relations.where(second), path, 1)
    assert _tables(stream.read_knowledge_base(spark, path)) == before
    assert stream.compact(spark, path) == 0
    assert _tables(stream.read_knowledge_base(spark, path)) == before
    assert stream.append_batch(linked.where(second), relations.where(second), path, 1)
    _same(stream.read_knowledge_base(spark, path), linked, relations)


def test_a_fold_that_dies_or_runs_beside_batches_changes_nothing(spark, linked, relations, tmp_path, monkeypatch):
    path = str(tmp_path / "kb")
    batch = lambda n: (linked.where(F.col("ord") == n + 1), relations.where(F.col("ord") == n + 1), path, n)
    for number in (0, 1, 3):
        stream.append_batch(*batch(number))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(stream, "_mark", dies)
        with pytest.raises(OSError):
            stream.compact(spark, path)
    assert stream.compact(spark, path) == 1  # number 2 is still to come
    for number in (0, 1, 3):
        assert not stream.append_batch(*batch(number))
    assert stream.append_batch(*batch(2))
    _same(stream.read_knowledge_base(spark, path), linked, relations)
    assert stream.compact(spark, path) == 3
    base = stream.read_knowledge_base(spark, path)
    _same(base, linked, relations)
    assert _lists(base) == {k: v[3] for k, v in ENTITIES.items()}


def test_nothing_committed(spark, tmp_path):
    path = str(tmp_path / "kb")
    assert all(df.count() == 0 for df in stream.read_knowledge_base(spark, path).values())
    assert stream.compact(spark, path) is None and stream.vacuum(spark, path) == 0


def test_stream_of_several_files_equals_one_run(spark, linked, relations, tmp_path):
    source = str(tmp_path / "in")
    for i in (1, 2, 3, 4):
        linked.where(F.col("ord") == i).coalesce(1).write.mode("append").parquet(source)
    frame = spark.readStream.schema(linked.schema).option("maxFilesPerTrigger", 1).parquet(source)

    def analyse(batch):
        return batch, relations.join(batch.select("ord").distinct(), "ord", "left_semi")

    stream.maintain(frame, analyse, str(tmp_path / "kb"), str(tmp_path / "check")).awaitTermination()
    assert stream.commits(spark, str(tmp_path / "kb")).count() == 4
    _same(stream.read_knowledge_base(spark, str(tmp_path / "kb")), linked, relations)


def test_a_batch_of_one_file_is_analysed_in_parts(spark, linked, relations, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("article_id"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    sizes = []

    def analyse(batch):
        sizes.extend(r["count"] for r in batch.groupBy(F.input_file_name()).count().collect())
        return linked, relations

    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    stream.maintain(source, analyse, str(tmp_path / "kb"), str(tmp_path / "checkpoint")).awaitTermination()
    assert sum(sizes) == 1000 and len(sizes) >= spark.sparkContext.defaultParallelism
    _same(stream.read_knowledge_base(spark, str(tmp_path / "kb")), linked, relations)
