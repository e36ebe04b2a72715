"""What the operators share: word and line splitting, and tables that are written once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.scratch import new_folder

# The white space of every contract here, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Stored(NamedTuple):
    """A table in the shared folder, and where it lies."""

    df: DataFrame
    path: str


# What the shuffles of an execution leave on disk goes when it ends, not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bytes that go to a Python worker at a time.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Other settings for a while."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored(df: DataFrame, label: str, batch_bytes: str | None = None) -> Stored:
    """Write `df` to the shared folder and go on from there, which cuts the lineage.

    Nothing reads the shuffles behind it again, so their files are deleted once it is written.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    with settings(spark, {SHUFFLES_GO: "true"} | ({BATCH_BYTES: batch_bytes} if batch_bytes else {})):
        df.write.parquet(path)
    return Stored(spark.read.schema(df.schema).parquet(path), path)


def discard(spark: SparkSession, *tables: Stored) -> None:
    """Delete tables that no returned DataFrame reads."""
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(table.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the fast path of lower()."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), F.array().cast("array<string>"))


def id_after(a: Column, b: Column) -> Column:
    """Whether identifier `a` comes after `b`; null comes last."""
    return F.coalesce(a > b, a.isNull() & b.isNotNull())
