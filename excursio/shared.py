"""Intermediate tables in the cluster's shared folder.

A written table cuts lineage the way ``checkpoint()`` does, but stays columnar: later reads
prune columns, push filters and carry real sizes into the join planner. It survives the loss
of any executor because nothing about it lives on a worker's disk.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session.

    Where none is set, a session whose tasks all run in this process gets a temporary folder;
    on a cluster, where executors would each write to a disk of their own, that is an error.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="excursio-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def write_shared(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader over it."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(written: DataFrame) -> None:
    """Delete what ``write_shared`` has written, once nothing reads it any more.

    Only folders that lie directly in the shared folder are deleted.
    """
    spark = written.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    shared = hadoop.Path(shared_folder(spark))
    files = shared.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = files.makeQualified(shared)
    for folder in {file.rsplit("/", 1)[0] for file in written.inputFiles()}:
        path = files.makeQualified(hadoop.Path(folder))
        if path.getParent().equals(root):
            files.delete(path, True)
