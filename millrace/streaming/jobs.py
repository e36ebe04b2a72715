"""Structured Streaming jobs. Every sink writes a folder per batch id, so a repeated batch
replaces its own output."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.goals import current, merged, registers
from millrace.operators.quality import Rule, error_rows, judged, valid_rows
from millrace.operators.sequences import merged_bits, month_bits
from millrace.session import at_most_partitions


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream; the path may be a folder or one file."""
    folder, _, name = path.rpartition("/")
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Spark takes a plain path for a folder, while a pattern may match a file as well.
    return reader.parquet(f"{folder}/{{{name}}}")


# A stateful stream keeps one state store per shuffle partition for as long as it lives, and cannot change their number
# later: give it as many as the keys that are expected call for. No more are started than the session's shuffles have.
STATE_PARTITIONS = 1_000


def _start(
    stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str, state_partitions: int | None = None
) -> StreamingQuery:
    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if not state_partitions:
        return writer.start()
    with at_most_partitions(stream.sparkSession, state_partitions):
        return writer.start()


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that a stream's watermark has dropped so far."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


# --- counts that are updated as events arrive --------------------------------------------

def completions_by_day(events: DataFrame, ts: str, user: str, late: str = "1 day") -> DataFrame:
    """Completions per user in one-day windows; events later than `late` are dropped."""
    return (
        events.withColumn("_ts", F.col(ts).cast("timestamp"))
        .withWatermark("_ts", late)
        .groupBy(F.window("_ts", "1 day").alias("w"), user)
        .agg(F.count("*").alias("n"))
        .select(F.to_date("w.start").alias("day"), user, "n")
    )


def completions_by_user(events: DataFrame, user: str) -> DataFrame:
    return events.groupBy(user).agg(F.count("*").alias("n"))


def keep_updates(
    counts: DataFrame, path: str, checkpoint: str, keys: list[str], every: int | None = None, state_partitions: int = STATE_PARTITIONS
) -> StreamingQuery:
    """Write each batch's changed rows, and now and then the last row of every key."""
    return _kept(counts, path, checkpoint, "update", lambda df: df, lambda rows: _last(rows, keys), every, state_partitions)


def _last(rows: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    # As one struct: a field that is null in the last row is null.
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_last"))
    return last.select(*keys, "_last.*")


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last count written for every key."""
    return _state(spark, path, lambda rows: _last(rows, keys))


# --- batches and snapshots -----------------------------------------------------------------
#
# A batch's rows go to changes/batch=n. Snapshot n holds the merged rows of all batches up to n and is made from the
# snapshot before it, whatever the distance. What the snapshot before covers is then removed; the rest is kept, since a
# batch that is repeated after a failure makes its snapshot again.

# Batches between two snapshots.
SNAPSHOT_EVERY = 20


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n of the folders name=n, in order; a folder without a finished write does not count."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    done = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().partition("=")[2]) for s in done)


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _rows_since(spark: SparkSession, path: str, snapshot: int, upto: int | None = None) -> DataFrame | None:
    """The rows of a snapshot and of the batches after it, with their batch."""
    parts = [(f"{path}/snapshots/upto={snapshot}", snapshot)] if snapshot >= 0 else []
    parts += [(f"{path}/changes/batch={n}", n) for n in _numbers(spark, f"{path}/changes", "batch") if n > snapshot and (upto is None or n <= upto)]
    out = None
    for folder, n in parts:
        rows = spark.read.parquet(folder).withColumn("batch", F.lit(n).cast("bigint"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _state(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    newest = max(_numbers(spark, f"{path}/snapshots", "upto"), default=-1)
    rows = _rows_since(spark, path, newest)
    if rows is None:
        raise FileNotFoundError(f"no batch has been written to {path}")
    return merge(rows)


def _kept(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str,
    reduce: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame], DataFrame],
    every: int | None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    every = every or SNAPSHOT_EVERY

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        reduce(df).write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")
        before = max((n for n in _numbers(spark, f"{path}/snapshots", "upto") if n < batch_id), default=-1)
        if batch_id - before < every:
            return
        merge(_rows_since(spark, path, before, batch_id)).write.mode("overwrite").parquet(f"{path}/snapshots/upto={batch_id}")
        for n in _numbers(spark, f"{path}/changes", "batch"):
            if n <= before:
                _remove(spark, f"{path}/changes/batch={n}")
        for n in _numbers(spark, f"{path}/snapshots", "upto"):
            if n < before:
                _remove(spark, f"{path}/snapshots/upto={n}")

    return _start(stream, batch, checkpoint, mode, state_partitions)


# --- goals -------------------------------------------------------------------------------

def fold_goals(events: DataFrame, path: str, checkpoint: str, every: int | None = None) -> StreamingQuery:
    """Write what each batch sets, and now and then the whole state.

    A batch's own settings merge with any others, so a batch does not read the state.
    """
    return _kept(events, path, checkpoint, "append", lambda df: merged(registers(df)), merged, every)


def latest_goals(spark: SparkSession, path: str) -> DataFrame:
    """The goals after the last batch."""
    return current(_state(spark, path, merged))


# --- days of activity --------------------------------------------------------------------

def fold_months(done: DataFrame, user: str, day: str, path: str, checkpoint: str, every: int | None = None) -> StreamingQuery:
    """Write each batch's active days by user and month, and now and then those of all batches; no history is kept."""
    def merge(rows: DataFrame) -> DataFrame:
        return merged_bits(rows, user)

    return _kept(done, path, checkpoint, "append", lambda df: month_bits(df, user, day), merge, every)


def latest_months(spark: SparkSession, path: str, user: str) -> DataFrame:
    return _state(spark, path, lambda rows: merged_bits(rows, user))


# --- continuous validation ---------------------------------------------------------------

def ingest(stream: DataFrame, rules: list[Rule], row: str, valid_path: str, errors_path: str, checkpoint: str) -> StreamingQuery:
    """Split every batch into valid rows and error rows."""
    def batch(df: DataFrame, batch_id: int) -> None:
        checked = judged(df, rules).persist()
        try:
            valid_rows(checked).write.mode("overwrite").parquet(f"{valid_path}/batch={batch_id}")
            error_rows(checked, row).write.mode("overwrite").parquet(f"{errors_path}/batch={batch_id}")
        finally:
            checked.unpersist()

    return _start(stream, batch, checkpoint, "append")


# --- days that are closed once, with late rows kept ------------------------------------------
#
# A batch is held against the watermark that the batches before it have left: the latest time seen less `late`. Rows of
# days that ended by then are late and go to a table of their own, whole. The others are counted into the days that are
# open; rows without a time stay there. Days that end by the watermark this batch leaves are final: they are written once and are no longer carried. What
# a batch reads is what the batch before it wrote, so a batch that is repeated writes the same again, and what is carried
# is a count for each user of an open day.

def close_days(
    events: DataFrame, ts: str, user: str, path: str, checkpoint: str, late: dt.timedelta = dt.timedelta(days=1)
) -> StreamingQuery:
    """Counts per day and user: final/ once a day is over, open/ until then, late/ for the rows that came after that."""
    delay = F.lit(late)

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        # The latest batch before this one; numbers may be left out, as an empty batch has none.
        before = max((n for n in _numbers(spark, f"{path}/marks", "batch") if n < batch_id), default=None)
        mark = spark.read.parquet(f"{path}/marks/batch={before}").first()["latest"] if before is not None else None
        day = F.to_date(ts)
        ends = (F.date_add(day, 1)).cast("timestamp_ntz")
        is_late = F.coalesce(ends <= F.lit(mark).cast("timestamp_ntz") - delay, F.lit(False))
        df.where(is_late).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        counts = df.where(~is_late).groupBy(day.alias("day"), user).agg(F.count("*").alias("n"), F.max(ts).cast("timestamp_ntz").alias("latest"))
        counts.write.mode("overwrite").parquet(f"{path}/new/batch={batch_id}")
        new = spark.read.parquet(f"{path}/new/batch={batch_id}")
        latest = new.agg(F.max("latest")).first()[0]
        latest = max((x for x in (latest, mark) if x is not None), default=None)
        spark.range(1).select(F.lit(latest).cast("timestamp_ntz").alias("latest")).write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")
        carried = new.drop("latest")
        if before is not None:
            carried = carried.unionByName(spark.read.parquet(f"{path}/open/batch={before}"))
        carried = carried.groupBy("day", user).agg(F.sum("n").alias("n"))
        over = F.coalesce(F.date_add("day", 1).cast("timestamp_ntz") <= F.lit(latest).cast("timestamp_ntz") - delay, F.lit(False))
        carried.where(over).write.mode("overwrite").parquet(f"{path}/final/batch={batch_id}")
        carried.where(~over).write.mode("overwrite").parquet(f"{path}/open/batch={batch_id}")
        for name in ("open", "new"):
            for n in _numbers(spark, f"{path}/{name}", "batch"):
                if before is not None and n < before:
                    _remove(spark, f"{path}/{name}/batch={n}")

    return _start(events, batch, checkpoint, "append")


def closed_days(spark: SparkSession, path: str) -> DataFrame:
    """Rows (kind, day, user, n): final days, and those open after the last batch."""
    last = max(_numbers(spark, f"{path}/marks", "batch"))
    final = spark.read.parquet(f"{path}/final").drop("batch")
    return final.withColumn("kind", F.lit("final")).unionByName(spark.read.parquet(f"{path}/open/batch={last}").withColumn("kind", F.lit("open")))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came after their day was final, with their batch."""
    return spark.read.parquet(f"{path}/late")
