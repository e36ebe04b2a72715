"""Rows up to a marker, and days of activity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import activity_level
from millrace.scratch import written


def before_marker(df: DataFrame, group: str, order: str, marker: Column) -> DataFrame:
    """Rows of each group before its first marker row; all rows where there is none.

    The first marker is a plain minimum, so no group has to be sorted in one place. Adaptive
    execution splits a hot group only where both join sides come straight from a shuffle, which
    an aggregate on one side would prevent, hence the written table.
    """
    stops = df.filter(marker).groupBy(F.col(group).alias("_group")).agg(F.min(order).alias("_stop"))
    stops = written(stops, "stops")
    joined = df.join(stops, F.col(group) == F.col("_group"), "left")
    return joined.filter(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_group", "_stop")


def streaks(done: DataFrame, user: str, day: str, as_of: dt.date) -> DataFrame:
    """Consecutive days with activity that end on `as_of`, per user; 0 without activity that day.

    Days are made distinct before the window, which bounds a user's rows by the calendar.
    """
    days = done.filter(F.col(day) <= F.lit(as_of)).select(user, day).distinct()
    newest_first = Window.partitionBy(user).orderBy(F.col(day).desc())
    numbered = days.withColumn("_back", F.row_number().over(newest_first) - 1)
    unbroken = F.datediff(F.lit(as_of), F.col(day)) == F.col("_back")
    return numbered.groupBy(user).agg(F.count_if(unbroken).alias("streak"))


def month_bits(done: DataFrame, user: str, day: str) -> DataFrame:
    """Rows (user, month, bits): the days of a month with activity, the first of the month as bit 0.

    This is all that runs of days need of a history. Parts of it, over any split of the rows, in any order and however
    often they are repeated, merge by `merged_bits`.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(day) - 1)
    month = F.trunc(F.col(day).cast("date"), "month")
    return done.where(F.col(day).isNotNull()).groupBy(F.col(user), month.alias("month")).agg(F.bit_or(bit).alias("bits"))


def merged_bits(parts: DataFrame, user: str) -> DataFrame:
    return parts.groupBy(user, "month").agg(F.bit_or("bits").alias("bits"))


def runs_of_days(bits: DataFrame, user: str, as_of: dt.date) -> DataFrame:
    """Rows (user, streak, longest, days) up to `as_of`: the run that ends there, the longest one, and all active days.

    A user's months are bounded by the calendar, and only they meet.
    """
    days = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(30)), lambda i: F.call_function("shiftright", F.col("bits"), i).bitwiseAND(1) == 1),
        lambda i: F.date_add("month", i),
    )
    past = bits.where(F.col("month") <= F.lit(as_of)).select(user, "month", F.filter(days, lambda d: d <= F.lit(as_of)).alias("days"))
    months = F.array_sort(F.collect_list(F.struct("month", "days")))
    none = F.struct(F.lit(0).alias("run"), F.lit(0).alias("longest"), F.lit(None).cast("date").alias("last"))

    def step(a: Column, d: Column) -> Column:
        run = F.when(F.date_add(a["last"], 1) == d, a["run"] + 1).otherwise(1)
        return F.struct(run.alias("run"), F.greatest(a["longest"], run).alias("longest"), d.alias("last"))

    folded = past.groupBy(user).agg(F.flatten(F.transform(months, lambda m: m["days"])).alias("days")).where(F.size("days") > 0).select(
        user, F.size("days").alias("days"), F.aggregate("days", none, step).alias("runs")
    )
    streak = F.when(F.col("runs.last") == F.lit(as_of), F.col("runs.run")).otherwise(0)
    return folded.select(user, streak.cast("bigint").alias("streak"), F.col("runs.longest").cast("bigint").alias("longest"), F.col("days").cast("bigint").alias("days"))


def daily_activity(done: DataFrame, day: str, as_of: dt.date, days: int = 84) -> DataFrame:
    """One row for each of the last `days` days with its count and level, empty days included."""
    first = as_of - dt.timedelta(days=days - 1)
    spark = done.sparkSession
    calendar = spark.range(days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"))
    counts = (
        done.filter(F.col(day).between(F.lit(first), F.lit(as_of)))
        .groupBy(F.col(day).alias("day"))
        .agg(F.count("*").alias("n"))
    )
    filled = calendar.join(counts, "day", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return filled.withColumn("level", activity_level("n"))
