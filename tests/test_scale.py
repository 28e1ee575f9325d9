import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from newsgraph.operators import scale as sc
from newsgraph import scratch


@pytest.fixture
def skewed(spark):
    """A third of all rows carry one key."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("k"),
        (F.hash("id") % 50).alias("v"))


@pytest.mark.parametrize("hot_rows", [1, 100, 10**9])
def test_lookup_join_keeps_every_row(skewed, rows, hot_rows):
    dim = skewed.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    expected = rows(skewed.join(dim, "k"), "id", "k", "top")
    assert rows(sc.lookup_join(skewed, dim, "k", "n", ["id"], hot_rows=hot_rows), "id", "k", "top") == expected


def test_salt_spreads_a_hot_key(skewed):
    dim = skewed.groupBy("k").agg(F.count("*").alias("n"))
    plan = sc.lookup_join(skewed, dim, "k", "n", ["id"], hot_rows=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_ranks_equal_a_plain_window(skewed, rows):
    order = [F.desc("v"), F.col("id")]
    expected = rows(skewed.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(*order))), "id", "rank")
    assert rows(sc.range_rank(skewed, ["k"], order), "id", "rank") == expected
    hashed = skewed.withColumn("h", F.md5(F.col("id").cast("string")))
    got = sc.bucketed_rank(hashed, [F.col("h")], F.substring("h", 1, 2), ["k"], "rank", "total")
    plain = hashed.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("h")))
    assert rows(got, "id", "rank") == rows(plain, "id", "rank")
    assert got.where("k = 'hot'").select("total").distinct().collect()[0][0] == 1000
    whole = sc.bucketed_rank(hashed, [F.col("h")], F.substring("h", 1, 2), [], "rank")
    assert rows(whole, "rank") == [(i,) for i in sorted(range(1, 3001), key=lambda i: repr((i,)))]


def test_broadcast_only_below_the_checked_size(skewed):
    def hinted(frame):
        return "broadcast" in frame._jdf.queryExecution().logical().toString().lower()

    assert hinted(sc.broadcast_if_small(skewed, 3000)) and not hinted(sc.broadcast_if_small(skewed, 2999))


class _Session:
    """Stands in for a cluster session; the setting is fixed once a real session runs."""

    def __init__(self, setting, master="yarn"):
        self.conf = self
        self.sparkContext = self._jsc = self
        self.setting, self.master = setting, master

    def get(self, name, default):
        return self.setting if name == "spark.checkpoint.dir" else default

    def sc(self):
        return self

    def getCheckpointDir(self):
        return self

    def isDefined(self):
        return False


def test_scratch_follows_the_session_setting(spark):
    assert scratch.fresh_path(_Session("hdfs://shared/dir/"), "x").startswith("hdfs://shared/dir/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_dir(_Session(None))
    assert scratch.materialise(spark.range(3), "y").count() == 3


def test_spread_only_for_small_scans(spark):
    assert sc.spread(spark.range(10).coalesce(1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sc.spread(spark.range(0, 100, 1, 40), "id").rdd.getNumPartitions() == 40


def test_spread_shares_one_row_group(spark, tmp_path):
    """A file of one row group has many splits and one task that reads rows."""
    path = str(tmp_path / "one")
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        frame = spark.read.parquet(path)
        assert frame.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        sizes = [r["count"] for r in sc.spread(frame, "id").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(sizes) == 20_000 and max(sizes) < 15_000
