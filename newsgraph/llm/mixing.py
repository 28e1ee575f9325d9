"""Mix sources to target weights by Poisson replication.

Each document is repeated k times, k drawn from a Poisson distribution whose mean is the target repetition rate of its
source. The draw inverts the distribution at a number hashed from seed and document, so it needs no state, is the same
after a lost executor, and no task has to know what another drew. The copies are then shuffled globally.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsgraph.llm.batches import fresh_name
from newsgraph.operators.scale import broadcast_if_small

# A rate above this is drawn as a sum of several Poisson numbers of equal smaller rates, so that exp(-rate) stays exact.
CHUNK_RATE = 32.0
# Terms of the distribution beyond the first; at a rate of 32 what lies beyond is below 2^-53.
TERMS = 120


def hashed_uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of the md5 of the parts, joined by colons; null parts are left out."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def repetition_rates(df: DataFrame, weights: Mapping[str | None, float] | None, source: str, rows: float | None = None) -> DataFrame:
    """One row per source: `_source`, `_chunks`, and `_cdf` of the Poisson distribution of one chunk.

    A source's rate is (its share of the weights) * (rows wanted) / (its rows); without weights all sources get the same
    share. A source that the weights do not name gets none. `rows` defaults to the number of rows there are.
    """
    counts = df.groupBy(F.col(source).cast("string").alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    if weights is None:
        weighed = counts.withColumn("_weight", F.lit(1.0))
    else:
        listed = [(k, float(v)) for k, v in weights.items()]
        if any(not 0 <= v < float("inf") for _, v in listed):
            raise ValueError("weights must be finite and not negative")
        table = df.sparkSession.createDataFrame(listed, "_name string, _weight double")
        same = F.col("_source").eqNullSafe(F.col("_name"))
        weighed = counts.join(table, same, "left").drop("_name").fillna(0.0, ["_weight"])
    total = weighed.agg(F.sum("_n").alias("n"), F.sum("_weight").alias("w")).first()
    wanted = float(rows if rows is not None else total["n"] or 0)
    weight = float(total["w"] or 0)
    rate = F.col("_weight") / F.lit(weight if weight > 0 else 1.0) * F.lit(wanted) / F.col("_n")
    chunked = weighed.select("_source", rate.alias("_rate")).select(
        "_source", "_rate", F.greatest(F.lit(1), F.ceil(F.col("_rate") / CHUNK_RATE)).cast("int").alias("_chunks")
    )
    cdf = F.expr(
        f"""aggregate(sequence(1, {TERMS}),
              named_struct('p', exp(-_rate / _chunks), 'c', exp(-_rate / _chunks), 'a', array(exp(-_rate / _chunks))),
              (s, k) -> named_struct('p', s.p * (_rate / _chunks) / k, 'c', s.c + s.p * (_rate / _chunks) / k,
                                     'a', array_append(s.a, s.c + s.p * (_rate / _chunks) / k)),
              s -> s.a)"""
    )
    return chunked.select("_source", "_chunks", cdf.alias("_cdf"))


def mix(
    df: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    seed: int = 17,
    key: str = "doc_id",
    source: str = "source",
    rows: float | None = None,
    copy: str = "copy",
) -> DataFrame:
    """`df` with each row repeated as its source's rate and the row's draw say, in random order, with `copy` from 1 on.

    The sources' table is broadcast if it is small, otherwise joined with the optimiser's handling of skew; a source that
    holds a third of all rows is never gathered. Rows with equal key draw the same number; rows without a key draw as if
    they shared one. A null source is a source like any other. An empty table gives an empty one. Extra columns pass
    through; helper names give way to columns that are called alike.
    """
    copy = fresh_name(df, copy)
    rates = broadcast_if_small(repetition_rates(df, weights, source, rows))
    renamed = {c: fresh_name(df, c) for c in ("_source", "_chunks", "_cdf")}
    for old, new in renamed.items():
        rates = rates.withColumnRenamed(old, new)
    names = df.columns
    joined = df.join(rates, F.col(source).cast("string").eqNullSafe(F.col(renamed["_source"])))
    number = F.aggregate(
        F.transform(
            F.sequence(F.lit(0), F.col(renamed["_chunks"]) - 1),
            lambda j: F.size(
                F.filter(F.col(renamed["_cdf"]), lambda c: c <= hashed_uniform(F.lit(seed), F.col(key), j))
            ),
        ),
        F.lit(0),
        lambda total, k: total + k,
    )
    drawn, order = fresh_name(joined, "_drawn"), fresh_name(joined, "_order")
    strings = [F.col(f"`{name}`") for name, kind in df.dtypes if kind == "string"]  # what tells rows without a key apart
    copies = (
        joined.withColumn(drawn, number)
        .where(F.col(drawn) > 0)
        .select(*[F.col(f"`{n}`") for n in names], F.explode(F.sequence(F.lit(1), F.col(drawn))).alias(copy))
        .withColumn(
            order,
            F.when(F.col(key).isNull(), F.xxhash64(F.lit(seed), *strings, F.col(copy))).otherwise(F.xxhash64(F.lit(seed), F.col(key), F.col(copy))),
        )
    )
    return copies.repartition(F.col(order)).sortWithinPartitions(order).drop(order)
