"""A training corpus from raw documents: five stages, each one operator of newsgraph.llm on all that the one before kept.

Quality rules drop documents, SimHash leaves one document of each group, substring removal cuts repeated passages, mixing
repeats documents until every source has the same expected share, and byte-level BPE encodes (and decodes) what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgraph.llm import bpe, mixing, quality, simhash, substring
from newsgraph.scratch import materialise

MIX_SEED = 29


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from the labels."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return simhash.one_of_each_group(docs, words=3, distance=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 13-word windows that earlier ones have; a text that loses nothing stays as it is."""
    columns = docs.columns
    cut = substring.without_repeats(docs, keep_untouched=True).select(*columns)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson numbers, so that every source gets the same expected share, in random order."""
    return mixing.mix(docs, seed=MIX_SEED).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded bytes of every row."""
    ready = bpe.model_and_spec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(docs, *ready)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

# The learned rules and XXH64 have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
