"""The pipeline: each stage on its own input against brute force, and as a whole."""

import hashlib
import struct
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from newsgraph.llm import bpe

from .test_groups import brute_fingerprint, union
from .test_texts import brute_cut, draws

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after each stage, written and read like the driver does."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "substring_dedup", "mix_sources", "byte_bpe"]


def test_columns(stages):
    assert [columns for _, _, columns in stages[:-1]] == [COLUMNS] * 4


def test_quality(spark):
    """At the smallest scale eleven rows are labelled bad, too few to learn from; at the next there are 58."""
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {tuple(r) for r in docs.collect()}
    after = corpus_pipeline.STAGES[0][1](spark, docs, sf).collect()
    assert after and all(tuple(r) in rows for r in after)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    good, bad = ([d for d, q in quality.items() if q == value] for value in (1, 0))
    assert sum(d in kept for d in good) >= 0.9 * len(good)
    assert sum(d in kept for d in bad) <= 0.1 * len(bad)


def test_simhash(stages):
    before, after, _ = stages[1]
    marks = [(r.doc_id, brute_fingerprint(r.text)) for r in before]
    pairs = [(a, b) for a, x in marks for b, y in marks if a < b and (x ^ y).bit_count() <= 2]
    groups = union([d for d, _ in marks], pairs)
    assert sorted(r.doc_id for r in after) == sorted(d for d in groups if groups[d] == d)


def test_substring(stages):
    before, after, _ = stages[2]
    expected = {e[0]: e for e in brute_cut([(r.doc_id, r.text) for r in before])}
    old = {r.doc_id: r for r in before}
    assert len(after) == len(before)
    for r in after:
        if expected[r.doc_id][2]:
            assert hashlib.sha256(r.text.encode()).hexdigest() == expected[r.doc_id][3]
        else:
            assert r.text == old[r.doc_id].text
        assert r.n_chars == len(r.text)


def test_mixing(stages):
    before, after, _ = stages[3]
    sizes = Counter(r.source for r in before)
    expected = Counter({tuple(r): draws(corpus_pipeline.MIX_SEED, r.doc_id, len(before) / (len(sizes) * sizes[r.source])) for r in before})
    assert Counter(tuple(r) for r in after) == +expected


def test_encoding(stages):
    before, after, _ = stages[4]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter()
    for r in before:
        ids = library.encode_ordinary(r.text or "")
        expected[(r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in after) == expected


def test_run_is_the_stages(spark, stages):
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == Counter(tuple(r) for r in stages[-1][1])


def test_messy_and_empty(spark, messy, empty, tmp_path, labels):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for kind, docs in (("messy", messy), ("empty", empty)):
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{kind}")
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            after = spark.read.parquet(path)
            assert name == "byte_bpe" or after.columns == docs.columns
            docs = after
