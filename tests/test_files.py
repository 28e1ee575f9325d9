import json

import pytest

from newsgraph.sources import readers as rd
from newsgraph.sources import sinks as sk


def test_format_by_suffix():
    assert [rd.format_of(p) for p in ("a.csv", "/x/b.TSV", "c.txt", "d.json.gz", "e.parquet/")] == ["csv", "tsv", "txt", "json", "parquet"]
    for path in ("a.xlsx", "a.xls", "a.doc", "plain"):
        with pytest.raises(ValueError):
            rd.format_of(path)


def test_articles_with_line_breaks_and_nulls(spark, tmp_path):
    frame = spark.createDataFrame([(7, 'say "hi"\nline, two', "u1"), (8, None, "u2")], "n long, Text string, Link string")
    sk.write_table(frame, str(tmp_path / "a.csv"), "csv")
    got = {r["article_id"]: (r["url"], r["text"]) for r in rd.read_articles(spark, str(tmp_path / "a.csv"), identity="n").collect()}
    assert got == {7: ("u1", 'say "hi"\nline, two'), 8: ("u2", "")}
    numbered = rd.read_articles(spark, str(tmp_path / "a.csv"))
    assert numbered.select("article_id").distinct().count() == 2
    with pytest.raises(ValueError, match="Body"):
        rd.read_articles(spark, str(tmp_path / "a.csv"), text="Body")


def test_triples_text_and_missing_part(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a\tlikes\tb\nc\t\td\n")
    got = [(r["Entity1"], r["Predicate"], r["Sentence"]) for r in rd.read_sentences(spark, str(tmp_path / "t.txt")).collect()]
    assert got == [("a", "likes", "a likes b"), ("c", None, "")]


def test_headers(spark):
    frame = spark.createDataFrame([("a", "b", "c")], [" Head", "RelationType ", "TAIL"])
    assert rd.alias_headers(rd.normalise_headers(frame)).columns == ["entity1", "predicate", "entity2"]
    twice = spark.createDataFrame([("a", "b", "c", "d")], ["head", "subject", "relation", "tail"])
    with pytest.raises(ValueError, match="entity1"):
        rd.alias_headers(twice)
    with pytest.raises(ValueError, match="entity2, predicate"):
        rd.require_columns(frame.toDF("entity1", "x", "y"), ["entity1", "predicate", "entity2"])


def test_missing_split_is_an_error(spark, tmp_path):
    frame = spark.createDataFrame([("a", "p", "b", "valid")], "entity1 string, predicate string, entity2 string, split string")
    sk.write_splits(frame, str(tmp_path / "s"))
    assert rd.read_splits(spark, str(tmp_path / "s"), ["valid"])["valid"].count() == 1
    with pytest.raises(FileNotFoundError, match="train_small"):
        rd.read_splits(spark, str(tmp_path / "s"))


def test_entity_sink_leaves_attributes_out(spark, tmp_path):
    frame = spark.createDataFrame([("ORG", "a", "entities"), ("DATE", "b", "attributes")], "type string, text string, category string")
    sk.write_entities(frame, str(tmp_path / "e"))
    assert sorted(p.name for p in (tmp_path / "e").glob("type=*")) == ["type=ORG"]
    sk.write_entities(frame, str(tmp_path / "f"), attributes=True)
    assert sorted(p.name for p in (tmp_path / "f").glob("type=*")) == ["type=DATE", "type=ORG"]
    assert sk.write_table(None, str(tmp_path / "none")) is False


def test_nested_columns_become_json_in_csv(spark, tmp_path):
    frame = spark.createDataFrame([(1, ["a", "b"])], "id int, t array<string>")
    sk.write_articles(frame, str(tmp_path / "n"))
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "n")).first()["t"] == '["a","b"]'


def test_unnumbered_rows_follow_file_names_not_file_sizes(spark, tmp_path):
    """Spark deals the largest file first; the numbers still go by file name and row in the file."""
    path = tmp_path / "t.json"
    path.mkdir()
    texts = [["a0"], [f"b{i:04d}" + "x" * 200 for i in range(2000)], ["c0", "c1"]]
    for name, rows in zip("abc", texts):
        (path / f"{name}.json").write_text("".join(json.dumps({"Text": t, "Link": "l"}) + "\n" for t in rows))
    read = rd.read_articles(spark, str(path), schema="Text string, Link string")
    got = [(r["article_id"], r["text"]) for r in read.orderBy("article_id").collect()]
    assert got == list(enumerate(t for rows in texts for t in rows))


def test_csv_keeps_blanks_at_the_ends_of_a_field(spark, tmp_path):
    frame = spark.createDataFrame([(1, "  two blanks  ")], "id int, t string")
    sk.write_table(frame, str(tmp_path / "b"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "b")).first()["t"] == "  two blanks  "
