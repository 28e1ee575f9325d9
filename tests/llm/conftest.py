import pytest
from pyspark.sql import types as T

# doc_id, text, lang, source, n_chars, and columns that clash with names the operators use themselves
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in ("n_words", "copy", "row", "tag", "ids", "_id", "fp", "kept")],
])
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau upsilon"
TEXTS = [
    "", None, "   \n\t ", "one", "Zwei Wörter", WORDS, WORDS, WORDS.upper(), f"before {WORDS} after", f"{WORDS}\n{WORDS}", LONG, "x" * 5_000,
    " no break spaces", "日本語のテキスト 🙂 ok", "###$$$ %%% &&&", "a\x00b \x1c c\x85d", "line\n" * 70, "the the the the the the",
]


def messy_rows():
    extra = ["clash"] * 8
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 3}", None if t is None else len(t), *extra) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5]]  # repeated rows
    rows += [(None, WORDS, None, None, None, *extra), (None, None, None, None, None, *extra), (5, "another text under the same id", None, "s1", None, *extra)]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(18)] + [(5, None, None), (None, 1, 1), (99, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
