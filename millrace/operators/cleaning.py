"""Filling, outliers, type conversion and codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.functions.predicates import outside
from millrace.operators.aggregates import mode_of
from millrace.operators.joins import looked_up
from millrace.operators.order_stats import exact_quantiles
from millrace.operators.ordered import numbered
from millrace.scratch import written


def fill_with_median(df: DataFrame, column: str) -> DataFrame:
    """Replace nulls and NaN by the exact median."""
    median = exact_quantiles(df, {column: [0.5]})[column][0]
    return df.withColumn(column, F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(None)), F.lit(median)))


def fill_with_mode(df: DataFrame, column: str) -> DataFrame:
    """Replace nulls by the most frequent value."""
    return df.withColumn(column, F.coalesce(column, mode_of(df, column).select(column).scalar()))


def iqr_bounds(df: DataFrame, column: str, reach: float = 1.5) -> dict[str, float]:
    q1, q3 = exact_quantiles(df, {column: [0.25, 0.75]})[column]
    if q1 is None:
        raise ValueError(f"{column} holds no values")
    spread = q3 - q1
    return {"q1": q1, "q3": q3, "low": q1 - reach * spread, "high": q3 + reach * spread}


def iqr_outliers(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    b = iqr_bounds(df, column, reach)
    return df.filter(outside(column, b["low"], b["high"]))


def iqr_kept(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    b = iqr_bounds(df, column, reach)
    return df.filter(F.col(column).between(b["low"], b["high"]))


def value_codes(df: DataFrame, column: str) -> DataFrame:
    """Code table: the distinct values numbered from 0 in sorted order."""
    values = df.filter(F.col(column).isNotNull()).select(column).distinct()
    return numbered(values, [F.col(column)], name="_at").select(
        column, (F.col("_at") - 1).cast("int").alias("code")
    )


def encoded(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Replace a column's values by codes; null becomes -1."""
    codes = value_codes(df, column).withColumnRenamed("code", name)
    return df.join(codes, column, "left").withColumn(name, F.coalesce(name, F.lit(-1)))


def date_columns(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns(
        {"year": F.year(date), "month": F.month(date), "weekday": S.weekday_name(date)}
    )


def cleaned_sales(raw: DataFrame, names: dict[str, str], to_date: Column | None = None) -> DataFrame:
    """Convert, fill, drop rows without a date, drop outliers, derive.

    `raw` has a text date, a numeric amount, a category and a region; `names` translates the
    category. The quantiles of the filled amounts are those of the rows that are kept, so the
    order of the steps matters.
    """
    # The searches below read the rows several times, so their dates are read once.
    typed = written(raw.withColumn("date", S.strict_date("date") if to_date is None else to_date), "typed")
    filled = fill_with_mode(fill_with_median(typed, "amount"), "category")
    dated = filled.na.drop(subset=["date", "amount"])
    kept = iqr_kept(dated, "amount")
    named = looked_up(kept, "category", names, "category_en")
    return date_columns(named.withColumn("category_upper", F.upper("category_en")), "date")
