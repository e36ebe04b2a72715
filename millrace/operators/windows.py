"""Ranks, differences and running totals over monthly totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import money_sum, month_start
from millrace.operators.ordered import numbered
from millrace.operators.paging import top


def monthly_totals(df: DataFrame, key: str, date: str, amount: str) -> DataFrame:
    """One row per key and month."""
    return df.groupBy(key, month_start(date).alias("month")).agg(
        money_sum(amount).alias("total")
    )


def numbered_in_month(monthly: DataFrame, key: str) -> DataFrame:
    """Unique position within the month by total, largest first, then key.

    A month holds every key, so its positions come from the sliced scan.
    """
    return numbered(monthly, [F.col("total").desc(), F.col(key)], ["month"])


def with_history(monthly: DataFrame, key: str) -> DataFrame:
    """Change from the key's previous row and the total so far.

    After the monthly sum a key has at most one row per calendar month, so its window is short.
    """
    in_time = Window.partitionBy(key).orderBy("month")
    return monthly.withColumns(
        {"change": F.col("total") - F.lag("total").over(in_time), "so_far": F.sum("total").over(in_time)}
    )


def ranked_top(df: DataFrame, value: str, key: str, k: int) -> DataFrame:
    """RANK and DENSE_RANK of the k largest rows.

    Both ranks depend only on larger values, and those are all among the k rows.
    """
    first = top(df, [(value, True), (key, False)], k)
    falling = Window.orderBy(F.col(value).desc())
    return first.withColumns({"rnk": F.rank().over(falling), "dense_rnk": F.dense_rank().over(falling)})
