"""Grouped, global and descriptive aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import average, money, money_sum, percent_done
from millrace.operators.ordered import numbered
from millrace.operators.order_stats import exact_quantiles
from millrace.operators.paging import by


def sum_by(df: DataFrame, keys: list[str], amount: str, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(money_sum(amount).cast("double").alias(name))


def count_by(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def totals_by(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """Sum, mean and row count per key; the mean leaves nulls out, the count does not."""
    return df.groupBy(*keys).agg(
        money_sum(amount).cast("double").alias("total"),
        average(amount).alias("avg"),
        F.count("*").alias("cnt"),
    )


def lists_by(
    df: DataFrame, key: str, value: Column, order: list[Column], size: int = 10_000, name: str = "items"
) -> DataFrame:
    """The values of each key in `order`, in pieces of at most `size`.

    A key's list may be any length, an array may not: piece 0, 1, 2 ... laid end to end are
    the list.
    """
    placed = numbered(df.withColumn("_value", value), order, [key], "_at")
    piece = F.floor((F.col("_at") - 1) / size).cast("long")
    return (
        placed.groupBy(key, piece.alias("piece"))
        .agg(F.array_sort(F.collect_list(F.struct("_at", "_value"))).alias("_pairs"))
        .select(key, "piece", F.col("_pairs._value").alias(name))
    )


def list_sizes(lists: DataFrame, key: str, name: str = "items") -> DataFrame:
    """Length of each key's list, from its pieces."""
    return lists.groupBy(key).agg(F.sum(F.size(name)).alias("n"))


def rollup_totals(
    facts: DataFrame,
    fact_key: str,
    dim: DataFrame,
    dim_key: str,
    label: str,
    fee: str,
    total_label: str,
    at_least: int,
) -> DataFrame:
    """Count and rounded mean fee per key and for all keys, groups below `at_least` left out.

    Facts are counted by key before the join, so a hot key crosses it as one row. Which row is
    the total comes from grouping(), not from a null key.
    """
    counted = facts.groupBy(fact_key).agg(F.count("*").alias("_n"))
    weighted = counted.join(dim, counted[fact_key] == dim[dim_key])
    rolled = (
        weighted.rollup(dim_key)
        .agg(
            F.grouping(dim_key).alias("_all"),
            F.max(label).alias("_label"),
            F.sum("_n").alias("cnt"),
            # A null fee takes no part in the mean.
            F.sum(F.when(F.col(fee).isNotNull(), F.col("_n"))).alias("_paying"),
            F.sum(money(fee) * F.col("_n")).alias("_fees"),
        )
        .filter(F.col("cnt") >= at_least)
    )
    is_total = F.col("_all") == 1
    return rolled.orderBy(F.col(dim_key).asc_nulls_last()).select(
        F.when(is_total, total_label).otherwise(F.col(dim_key).cast("string")).alias("key"),
        F.when(is_total, total_label).otherwise(F.col("_label")).alias("label"),
        "cnt",
        F.round(F.col("_fees").cast("double") / F.col("_paying"), 0).alias("avg_fee"),
    )


def mode_of(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value with its count, the smallest on ties; nulls are left out."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), F.asc(column)).limit(1)


def missing(df: DataFrame, column: str) -> Column:
    floating = dict(df.dtypes)[column] in ("double", "float")
    return F.col(column).isNull() | F.isnan(column) if floating else F.col(column).isNull()


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count and share of missing values per column, in one pass; NaN is missing too."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(missing(df, c)).alias(c) for c in columns])
    return (
        counts.unpivot("_rows", columns, "column", "nulls")
        .withColumn("pct", F.col("nulls") * 100.0 / F.nullif("_rows", F.lit(0)))
        .drop("_rows")
    )


def shape_report(df: DataFrame) -> DataFrame:
    """Position, type and filled rows of every column, next to the number of rows."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    places = F.create_map(*[F.lit(x) for i, c in enumerate(df.columns) for x in (c, i)])
    return counts.unpivot("rows", df.columns, "column", "filled").select(
        places[F.col("column")].alias("position"),
        "column",
        types[F.col("column")].alias("type"),
        "filled",
        "rows",
    )


QUARTILES = [0.25, 0.5, 0.75]


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column; NaN counts as missing."""
    quartiles = exact_quantiles(df, {c: QUARTILES for c in columns})
    stats = df.select(*[F.when(~missing(df, c), F.col(c)).alias(c) for c in columns]).agg(
        *[
            F.struct(
                F.count(c).alias("cnt"),
                F.round(F.avg(c), 6).alias("mean"),
                F.round(F.stddev_samp(c), 6).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )

    def quartile(i):
        pairs = [F.lit(x) for c in columns for x in (c, quartiles[c][i])]
        return F.round(F.create_map(*pairs)[F.col("column")].cast("double"), 6)

    return stats.unpivot([], columns, "column", "s").select(
        "column",
        "s.cnt",
        "s.mean",
        "s.std",
        "s.min",
        quartile(0).alias("q1"),
        quartile(1).alias("median"),
        quartile(2).alias("q3"),
        "s.max",
    )


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct values, most frequent value (smallest on ties) and its count per column."""
    values = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    counted = values.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))
    found = counted.groupBy("column").agg(
        F.sum("n").alias("cnt"), F.count("*").alias("uniq"), best.alias("b")
    )
    return found.select("column", "cnt", "uniq", F.col("b.value").alias("top"), (-F.col("b.neg")).alias("freq"))


def progress(df: DataFrame, done: Column) -> DataFrame:
    """Rows, rows done, and whole percent."""
    counts = df.agg(F.count("*").alias("total"), F.count_if(done).alias("done"))
    return counts.withColumn("pct", percent_done("done", "total"))


def remaining_by(df: DataFrame, category: str, done: Column, categories: list[str]) -> DataFrame:
    """Open rows for each listed category, zero included; other categories are left out."""
    spark = df.sparkSession
    listed = spark.createDataFrame([(i, c) for i, c in enumerate(categories)], "position int, category string")
    still_open = (
        df.filter(~F.coalesce(done, F.lit(False)) & F.col(category).isin(categories))
        .groupBy(F.col(category).alias("category"))
        .agg(F.count("*").alias("n"))
    )
    return listed.join(still_open, "category", "left").select("position", "category", F.coalesce("n", F.lit(0)).alias("n"))


def sum_of_squares(df: DataFrame, column: str, chunk: Column) -> DataFrame:
    """Sum of squares per chunk in decimals wide enough not to overflow."""
    wide = F.col(column).cast("decimal(19,0)")
    return df.groupBy(chunk.alias("chunk")).agg(F.sum(wide * wide).alias("squares"))


def heavy(df: DataFrame, key: str, amount: str, name: str = "total") -> DataFrame:
    """Keys whose total is above the mean of all totals."""
    totals = df.groupBy(key).agg(money_sum(amount).alias(name))
    mean = totals.agg((F.sum(name).cast("double") / F.count("*")).alias("mean"))
    return totals.withColumn(name, F.col(name).cast("double")).filter(F.col(name) > mean.scalar())


def largest_total(totals: DataFrame, name: str) -> DataFrame:
    """The largest group total next to the first row of the top list; they have to agree."""
    first = totals.orderBy(*by([(name, True)])).limit(1).select(name)
    return totals.agg(F.max(name).alias("largest")).select(
        "largest", first.scalar().alias("first"), (F.col("largest") == first.scalar()).alias("same")
    )
