"""Joins. Sides that may hold a hot key are grouped by it first or left to the skew-join split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import money_sum

# A broadcast side is copied to every executor, so it is measured first.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 2**20


def is_small(df: DataFrame) -> bool:
    """Few enough rows and, as text, few enough bytes to be copied to every executor; one job over a bounded prefix."""
    text = F.octet_length(F.to_json(F.struct(*df.columns)))
    first = df.limit(BROADCAST_ROWS + 1).agg(F.count("*").alias("rows"), F.sum(text).alias("bytes")).first()
    return first["rows"] <= BROADCAST_ROWS and (first["bytes"] or 0) <= BROADCAST_BYTES


def with_small(facts: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join a lookup table, broadcast when it proves to be small."""
    return facts.join(F.broadcast(small) if is_small(small) else small, on, how)


def star(facts: DataFrame, dims: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Inner joins of a fact table to dimensions given as (table, fact key, dimension key)."""
    out = facts
    for dim, fact_key, dim_key in dims:
        out = out.join(dim, F.col(fact_key) == F.col(dim_key))
    return out


def without_match(parents: DataFrame, key: str, children: DataFrame, child_key: str, only: Column | None = None) -> DataFrame:
    """Parents with no child; `only` restricts which children count. Parents have unique keys."""
    return parents.join(_keys(children, child_key, only), F.col(key) == F.col("_key"), "left_anti")


def with_match(parents: DataFrame, key: str, children: DataFrame, child_key: str, only: Column | None = None) -> DataFrame:
    """Parents, by unique key, with at least one child."""
    return parents.join(_keys(children, child_key, only), F.col(key) == F.col("_key"), "left_semi")


def _keys(children: DataFrame, child_key: str, only: Column | None) -> DataFrame:
    # Distinct keys only: a child key that fills a third of the table shrinks to one row per task.
    counted = children if only is None else children.filter(only)
    return counted.select(F.col(child_key).alias("_key")).distinct()


def with_total(parents: DataFrame, key: str, children: DataFrame, child_key: str, amount: str, name: str = "total") -> DataFrame:
    """Each parent with the sum over its children, null where it has none."""
    totals = children.groupBy(F.col(child_key).alias("_key")).agg(money_sum(amount).cast("double").alias(name))
    return parents.join(totals, F.col(key) == F.col("_key"), "left").drop("_key")


def looked_up(df: DataFrame, column: str, mapping: dict[str, str], name: str) -> DataFrame:
    """Add the translation of a column; values without an entry, null among them, become null."""
    entries = [(k, v) for k, v in mapping.items() if k is not None]
    table = df.sparkSession.createDataFrame(entries, "_key string, _value string")
    found = with_small(df.withColumn("_key", F.col(column)), table, "_key", "left")
    return found.select(*df.columns, F.col("_value").alias(name))
