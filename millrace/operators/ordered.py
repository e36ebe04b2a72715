"""Positions and running totals over groups of any size.

A window partitioned by the group alone would send a whole group to one task. Here the rows
are range-partitioned by (group, order) into slices, each slice is scanned on its own, and the
totals of the earlier slices of the same group are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.scratch import written


def _grouped(df: DataFrame, group: list[str] | None) -> DataFrame:
    # A struct compares and hashes null fields as equal, a bare null column would not join.
    return df.withColumn("_group", F.struct(*group) if group else F.struct(F.lit(0)))


def _earlier(per_slice: DataFrame, names: list[str]) -> DataFrame:
    """Totals of a group's earlier slices; a group has at most one row per slice."""
    earlier = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = [F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names]
    rest = [c for c in per_slice.columns if c not in names]
    return per_slice.select(*rest, *offsets)


# monotonically_increasing_id() is the partition in the upper bits and the row in the lower 33.
ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column], group: list[str] | None = None, name: str = "position") -> DataFrame:
    """Add a 1-based position in `order` within `group`.

    `order` has to be a total order within the group; nulls in `group` form a group.
    """
    ordered = (
        _grouped(df, group)
        .repartitionByRange(F.col("_group"), *order)
        .sortWithinPartitions(F.col("_group"), *order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    # The place of a row must not change when a task is run again, so it is written down.
    ordered = written(ordered, "ordered").withColumn("_slice", F.shiftright("_row", ROW_BITS))
    per_slice = ordered.groupBy("_slice", "_group").agg(F.min("_row").alias("_first"), F.count("*").alias("_before"))
    return ordered.join(_earlier(per_slice, ["_before"]), ["_slice", "_group"]).select(
        *df.columns, (F.col("_row") - F.col("_first") + F.col("_before") + 1).alias(name)
    )


def running(
    df: DataFrame,
    order: list[Column],
    totals: dict[str, Column],
    group: list[str] | None = None,
) -> DataFrame:
    """Add running totals in `order` within `group`, under the same conditions.

    Totals are of columns without nulls.
    """
    sliced = _grouped(df, group).repartitionByRange(F.col("_group"), *order).withColumn("_slice", F.spark_partition_id())
    sliced = written(sliced, "slices")

    in_slice = (
        Window.partitionBy("_slice", "_group")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned = sliced.select("*", *[F.sum(m).over(in_slice).alias(f"_in_{n}") for n, m in totals.items()])
    before = {n: f"_before_{n}" for n in totals}
    per_slice = sliced.groupBy("_slice", "_group").agg(*[F.sum(m).alias(before[n]) for n, m in totals.items()])
    return scanned.join(_earlier(per_slice, list(before.values())), ["_slice", "_group"]).select(
        *df.columns, *[(F.col(f"_in_{n}") + F.col(before[n])).alias(n) for n in totals]
    )
