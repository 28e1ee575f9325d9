"""Where intermediate tables are written, and how lineage is cut.

Intermediate results go to the shared folder named by ``spark.checkpoint.dir``. Only a local-mode session may
fall back to a folder on this machine: on a cluster a machine-local folder is lost with its executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder of this session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    existing = spark.sparkContext._jsc.sc().getCheckpointDir()
    if existing.isDefined():
        return existing.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="newsgraph-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written in here frees its shuffle files at its end: nobody reads them once the rows are in the shared folder.

    Otherwise they stay until the driver happens to collect garbage, and the steps of one query fill the disks together.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def forget(df: DataFrame) -> None:
    """Delete the files of a table that `materialise` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def forget_staged(df: DataFrame) -> None:
    """Delete the staged tables that `df` is derived from, which nothing reads any more; files outside of the shared folder stay."""
    spark = df.sparkSession
    home = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark)).toUri().getPath()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if place.toUri().getPath().startswith(f"{home}/"):
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends at files that outlive any executor."""
    path = fresh_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _shuffles_freed(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path) if not partition_by else df.sparkSession.read.parquet(path)


def fresh_table(name: str) -> str:
    """A new, unused name in the session's catalogue, for `deal`."""
    return f"{name}_{uuid.uuid4().hex}"


def deal(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Write `df`, or add it to what `table` has, dealt to buckets by the hash of `key` and sorted by it: later groupings and joins
    by `key` with tables dealt alike need no exchange. The files are in the shared folder; only the name is in the session's catalogue."""
    spark = df.sparkSession
    writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
    with _shuffles_freed(spark):
        if spark.catalog.tableExists(table):
            writer.mode("append").saveAsTable(table)
        else:
            writer.option("path", fresh_path(spark, table)).saveAsTable(table)
    return spark.table(table)
