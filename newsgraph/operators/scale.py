"""Building blocks for joins and rankings that stay whole when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsgraph.scratch import materialise

# A key with more rows than this is spread over several join tasks.
HOT_ROWS = 10_000_000
# A dictionary is broadcast only up to this many rows.
BROADCAST_ROWS = 500_000
# Parts of a split, and parts up to which a split is divided: each split writes to each part.
SPLIT_PARTS, MOST_PARTS = 4, 2_000
# Splits of less than this many bytes, by the planner's estimate, are not divided where each core has SPLIT_PARTS of them.
SMALL_SPLIT = 4_000_000


def parts(spark: SparkSession) -> int:
    """Tasks for work that is heavy per row: the session's shuffle partitions, but every core has one."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Repartition by `key`, so that text work, which is heavy per byte, is shared by all cores.

    The splits of a scan do not tell whether it is: a Parquet row group is read by the one task that has its middle,
    however many splits a file has. A table of many splits gets several parts for each, so that the longest task does not
    grow with the table.
    """
    splits, cores = df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    small = splits >= SPLIT_PARTS * cores and size < SMALL_SPLIT * splits
    divided = splits if small else min(SPLIT_PARTS * splits, MOST_PARTS)
    return df.repartition(max(parts(df.sparkSession), splits, divided), key)


def small_enough(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `max_rows` rows; reads at most one row more than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a checked size; otherwise unhinted, which leaves a shuffle join with AQE skew handling."""
    return F.broadcast(df) if small_enough(df, max_rows) else df


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    frequency: str,
    spread: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join `facts` to `dim`, which has few rows per `key` and knows in `frequency` how many facts carry the key.

    Keys with more than `hot_rows` facts are salted: their dim row is copied once per `hot_rows` facts and each fact
    goes to one copy by the hash of its `spread` columns. There are at most (number of facts / hot_rows) hot keys; they
    are broadcast up to the checked size, beyond it they are joined by a shuffle.
    """
    salts = F.ceil(F.col(frequency) / F.lit(hot_rows)).cast("int")
    hot = dim.where(F.col(frequency) > hot_rows).select(key, salts.alias("_salts")).distinct()
    salted_facts = facts.join(broadcast_if_small(hot), key, "left").withColumn(
        "_salt",
        F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(*spread), F.col("_salts").cast("long")).cast("int")
        ),
    ).drop("_salts")
    salted_dim = dim.withColumn(
        "_salt",
        F.explode(F.when(F.col(frequency) > hot_rows, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))),
    )
    return salted_facts.join(salted_dim, [key, "_salt"], how).drop("_salt")


def bucketed_rank(
    df: DataFrame,
    order: Sequence[Column],
    bucket: Column,
    groups: Sequence[str] = (),
    name: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """1-based rank of every row inside its group, without ever sorting a whole group in one task.

    `bucket` must grow with the first order column (for example its first characters). Rows are counted per bucket,
    the counts are summed up over the buckets, and only the rows of one bucket are sorted together. The one task per
    group that sums up the buckets sees as many rows as there are buckets. `total` adds the size of the group.
    """
    groups = list(groups)
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    so_far = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
    if total:
        offsets = offsets.withColumn(total, F.sum("_n").over(Window.partitionBy(*groups)))
    keys = [*groups, "_bucket"]
    renamed = [F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)]
    offsets = offsets.select(*renamed, "_before", *([total] if total else []))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(keys)])
    joined = rows.join(offsets, same, "inner").drop(*[f"_key{i}" for i in range(len(keys))])
    inside = Window.partitionBy(*keys).orderBy(*order)
    return joined.withColumn(name, F.row_number().over(inside) + F.col("_before")).drop("_bucket", "_before")


def range_rank(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """1-based rank of every row inside its group for any order, also when one group holds most of the rows.

    Rows are range-partitioned by group and order, so a large group spans several partitions. The partitioned rows are
    written to the shared folder first: their partition numbers must not change between counting and ranking.
    """
    spark = df.sparkSession
    groups = list(groups)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(partitions, *[F.col(g) for g in groups], *order)
    rows = materialise(ranged.withColumn("_part", F.spark_partition_id()), "ranked")
    so_far = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        *groups, "_part", F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*groups, "_part").orderBy(*order)
    ranked = rows.join(offsets, [*groups, "_part"]).withColumn(name, F.row_number().over(inside) + F.col("_before"))
    return ranked.drop("_part", "_before")
