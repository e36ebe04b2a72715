"""Intermediate tables that have to outlive a lost executor."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _test_root() -> str:
    return tempfile.mkdtemp(prefix="millrace-")


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster shares; only a local[...] session may go without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _test_root()


_made: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A path no other run uses."""
    path = f"{scratch_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Delete the folders this process made, once the results that read them are no longer needed."""
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and go on from the written table, which cuts the lineage."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
