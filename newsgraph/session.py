"""Session settings the operators are tuned for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# AQE coalesces small shuffles and splits skewed sort-merge partitions; the explicit salting in
# operators/scale.py covers the joins where a hot key is expected.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # recording a Python call site for every column makes building large expressions several times slower
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "newsgraph") -> SparkSession:
    """Local session for tests and the bench; on a cluster the caller brings the session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
