"""Registered queries of the training-data operators: name -> (query, checking SQL or None).

Every query reads its whole table; what it returns is derived from what its operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsgraph.llm import bpe, covertree, langid, lmscore, mixing, quality, simhash, sql, substring, token_counts, toxicity, variants, warc, whitening

MIX_SEED = 17


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9."""
    return covertree.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of all documents, decoded again."""
    ready = bpe.model_and_spec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(_table(spark, sf_dir, "documents"), *ready)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by models of those that are not held out."""
    return langid.languages(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by models of the labels that are not held out."""
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all documents by rules learned from all labels."""
    return quality.verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without the 13-word windows that earlier documents have."""
    return substring.removals(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents against a limit of 512."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        tokenizer = token_counts.Tokenizer(file.read(), public_tokenizers.PATTERN)
    return token_counts.budget(_table(spark, sf_dir, "documents"), tokenizer, limit=512)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives without repeated payloads, and read back."""
    return warc.deduplicated(_table(spark, sf_dir, "pages"))


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents repeated so that every source gets the same expected share, shuffled."""
    return mixing.mix(_table(spark, sf_dir, "documents"), seed=MIX_SEED)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents whose fingerprints of 3-word shingles link at 2 bits or fewer."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, distance=2)


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all documents by a self-attention model of subwords, beside the unigram base."""
    subwords = lmscore.Subwords.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return lmscore.scores(_table(spark, sf_dir, "documents"), subwords)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their most frequent near word and the root that such words lead to."""
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable vectors projected on the eight leading components of their covariance, with unit variances."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=8)


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_cover_tree": (op1_cover_tree, sql.COVER_TREE),
    "op2_byte_bpe": (op2_byte_bpe, None),
    "op3_language_id": (op3_language_id, None),
    "op4_toxicity": (op4_toxicity, None),
    "op5_quality_rules": (op5_quality_rules, None),
    "op6_substring": (op6_substring, sql.SUBSTRING),
    "op7_token_counts": (op7_token_counts, None),
    "op8_warc": (op8_warc, sql.WARC),
    "op9_poisson_mix": (op9_poisson_mix, sql.poisson_mix(MIX_SEED)),
    "op10_simhash": (op10_simhash, None),
    "op11_lm_scores": (op11_lm_scores, None),
    "op12_spelling_variants": (op12_spelling_variants, sql.SPELLING_VARIANTS),
    "op13_whitening": (op13_whitening, None),
}
