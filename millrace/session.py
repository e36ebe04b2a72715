"""Session settings the operators rely on."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings; none of them needs a restart.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the next step needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
# What the session had before any query raised it.
BEFORE = "millrace.shuffle.partitions.before"
# A shuffle partition should fit in an executor's memory. Columnar files grow about threefold
# when they are read, and adaptive execution merges partitions that turn out small.
PARTITION_BYTES = 512 * 2**20
GROWTH = 3
# Narrow rows of numbers grow 25-fold in a hash table (11 bytes of Parquet to 300), and a task may hold two. So their
# partitions are smaller, and adaptive execution may merge them to MERGED_BYTES of shuffled data only.
HASHED_GROWTH = 50
MERGED_BYTES = "16m"


def wanted_partitions(input_bytes: int, growth: int = GROWTH) -> int:
    return math.ceil(input_bytes * growth / PARTITION_BYTES)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder; 0 if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getLength() if files.exists(path) else 0


def size_shuffles(spark: SparkSession, input_bytes: int, growth: int = GROWTH) -> SparkSession:
    """As many shuffle partitions as the input calls for, and no fewer than the session was given.

    A query calls this anew, so a large input does not raise the number for the queries after it.
    """
    before = spark.conf.get(BEFORE, None) or spark.conf.get(SHUFFLE_PARTITIONS)
    spark.conf.set(BEFORE, before)
    spark.conf.set(SHUFFLE_PARTITIONS, str(max(int(before), wanted_partitions(input_bytes, growth))))
    return spark


def size_hash_tables(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Shuffles for queries whose tasks hold their partition in hash tables; `prepare` takes the smaller merges back."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", MERGED_BYTES)
    return size_shuffles(spark, input_bytes, HASHED_GROWTH)


@contextmanager
def at_most_partitions(spark: SparkSession, most: int) -> Iterator[None]:
    """Fewer shuffle partitions for a while."""
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    spark.conf.set(SHUFFLE_PARTITIONS, str(min(int(before), most)))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)


def local_session(cpus: int | str | None = None, app: str = "millrace") -> SparkSession:
    """A session on this machine, for tests and the bench."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
