"""Sorting, top-k and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.predicates import literal, past_key
from millrace.operators.order_stats import row_key_at

Order = list[tuple[str, bool]]


def by(order: Order) -> list[Column]:
    """Sort columns with nulls last in both directions."""
    return [F.col(n).desc_nulls_last() if d else F.col(n).asc_nulls_last() for n, d in order]


def top(df: DataFrame, order: Order, k: int) -> DataFrame:
    """First k rows of a total order."""
    return df.orderBy(*by(order)).limit(k)


def numbered_top(df: DataFrame, order: Order, k: int, name: str = "position") -> DataFrame:
    """Top k with a position from 1; the window sees only the k rows."""
    return top(df, order, k).withColumn(name, F.row_number().over(Window.orderBy(*by(order))))


def page_boundary(df: DataFrame, order: Order, offset: int) -> list | None:
    """Key of the last row before the page that starts at `offset`; None at the start and past the end."""
    return row_key_at(df, order, offset - 1) if offset > 0 else None


def keyset_page(df: DataFrame, order: Order, after: list, k: int) -> DataFrame:
    """k rows after a known row, whose key may have nulls; the order has to end in a unique key."""
    values = [None if v is None else literal(v, df.schema[name].dataType) for (name, _), v in zip(order, after)]
    return top(df.filter(past_key(order, values)), order, k)


def offset_page(df: DataFrame, order: Order, offset: int, k: int) -> DataFrame:
    """k rows from position `offset`, read as the keyset page behind its boundary."""
    if offset <= 0:
        return top(df, order, k)
    boundary = page_boundary(df, order, offset)
    if boundary is None:
        return df.limit(0)
    return keyset_page(df, order, boundary, k)
