"""Table layouts that let a filter skip files, statistics, and plan reports."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, key: str, date: str) -> None:
    """Files hold ranges of (key, date) in order, so `key = x AND date >= d` reads few row groups.

    A hash of the row is the last part of the range, so that a key and date which fill many files are spread over all
    of them.
    """
    df.repartitionByRange(F.col(key), F.col(date), F.xxhash64(*df.columns)).sortWithinPartitions(key, date).write.mode("overwrite").parquet(path)


# Ranges of each column along the curve: 2 ** CURVE_BITS.
CURVE_BITS = 6


def curve_position(columns: list[Column], cuts: list[list[Any]], bits: int = CURVE_BITS) -> Column:
    """A row's place on a Z-order curve: the bits of its columns' ranges, taken in turn from the highest on.

    `cuts` are the values that begin each column's ranges but the first, in order. Null is in the first range.
    """
    place = F.lit(0).cast("bigint")
    for i, (column, own) in enumerate(zip(columns, cuts)):
        rank = sum((F.coalesce(column >= F.lit(c), F.lit(False)).cast("bigint") for c in own), F.lit(0).cast("bigint"))
        for bit in range(bits):
            one = F.call_function("shiftright", rank, F.lit(bit)).bitwiseAND(1)
            place = place + F.call_function("shiftleft", one, F.lit(bit * len(columns) + len(columns) - 1 - i))
    return place


def write_curved(df: DataFrame, path: str, columns: list[str], files: int, bits: int = CURVE_BITS) -> None:
    """Files along a Z-order curve over the ranks of `columns`, numbers or dates: a filter on any one of them reads few.

    The ranges of a column hold about equally many rows, so skewed values do not crowd the curve; their limits come from
    one pass of mergeable sketches and only decide which rows lie together. A hash of the row is the last part of the
    order, so that a place on the curve that fills many files is spread over them.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(*[F.percentile_approx(c, shares, 100 * 2**bits).alias(f"p{i}") for i, c in enumerate(columns)]).first()
    limits = [sorted(set(cuts[f"p{i}"] or [])) for i in range(len(columns))]
    curved = df.withColumn("_curve", curve_position([F.col(c) for c in columns], limits, bits))
    spread = curved.repartitionByRange(files, F.col("_curve"), F.xxhash64(*df.columns)).sortWithinPartitions("_curve", *columns)
    spread.drop("_curve").write.mode("overwrite").parquet(path)


def write_by_month(df: DataFrame, path: str, date: str) -> None:
    """One folder per month; a month of any size is written in files of the advisory size."""
    (
        df.withColumn("month", F.date_format(date, "yyyy-MM"))
        .hint("rebalance", "month")
        .write.mode("overwrite")
        .partitionBy("month")
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """A catalog table whose files are dealt out and sorted by `key`.

    Joins and groups of such tables by `key`, with equally many buckets, move no rows. A bucket is one task then, and it
    is never split, so look at `bucket_rows` first: with a hot key a shuffled join, which is split, is the better one.
    """
    spread = df.repartition(buckets, key)  # one file a bucket
    spread.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def bucket_rows(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows (bucket, n) that write_bucketed would put into each bucket; a partial count a task."""
    return df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"))


def largest_share(sizes: DataFrame) -> float:
    """The largest bucket's share of all rows times the number of buckets in use: 1 if they are even."""
    row = sizes.agg(F.max("n").alias("most"), F.avg("n").alias("mean")).first()
    return row["most"] / row["mean"] if row["mean"] else 1.0


def write_with_filters(df: DataFrame, path: str, keys: list[str], rows_a_group: int | None = None) -> None:
    """Parquet with a Bloom filter on each key and row group, so that a lookup by an unsorted key skips groups without it.

    `rows_a_group` is how many distinct keys a filter is made for; without it the writer's own estimate holds.
    """
    writer = df.write.mode("overwrite")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        if rows_a_group:
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", rows_a_group)
    writer.parquet(path)


def rows_read(df: DataFrame) -> int:
    """Rows that the scans of a query hand on, after running it."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        elif name.startswith("Scan"):
            total += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def analyze(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Refresh a catalog table's statistics and report them per column."""
    spark = df.sparkSession
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    reports = []
    for c in columns:
        described = spark.sql(f"DESCRIBE EXTENDED {table} {c}")
        reports.append(described.select(F.lit(c).alias("column"), "info_name", "info_value"))
    out = reports[0]
    for r in reports[1:]:
        out = out.unionAll(r)
    return out.groupBy("column").pivot("info_name", ["min", "max", "num_nulls", "distinct_count"]).agg(F.first("info_value"))


def plan_text(df: DataFrame) -> str:
    """The plan as `explain` prints it."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def plan_features(df: DataFrame) -> dict[str, str]:
    """What the scan filters and reads, how it joins, and how it aggregates."""
    text = plan_text(df)

    def all_of(pattern):
        return "; ".join(sorted(set(re.findall(pattern, text))))

    return {
        "pushed": all_of(r"PushedFilters: \[(.*?)\]\n"),
        "partition_filters": all_of(r"PartitionFilters: \[(.*?)\]\n"),
        "read_schema": all_of(r"ReadSchema: (\S+)"),
        "joins": all_of(r"\b(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)\b"),
        "aggregates": all_of(r"\b(HashAggregate|SortAggregate|ObjectHashAggregate)\b"),
    }


def compare_plans(before: DataFrame, after: DataFrame) -> dict[str, tuple[str, str]]:
    """Plan features of two queries that should return the same rows, side by side."""
    first, second = plan_features(before), plan_features(after)
    return {k: (first[k], second[k]) for k in first}
