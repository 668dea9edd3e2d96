"""Session defaults.

Only runtime SQL settings that change correctness (time zone), let Spark repair skewed joins by
itself or free disk early are set here; partition counts and memory stay with the cluster.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split oversized partitions of a sort-merge join even when that costs one more shuffle
    # downstream: a single hot experience may own a third of all bookings.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A finished query's shuffle files go at once, not when the driver happens to collect its garbage:
    # a job of many writes would hold the shuffles of all of them.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # A stream's checkpoint keeps the state of the last batches only; a restart needs one.
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
