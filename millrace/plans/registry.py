"""Queries by name, each next to the SQL that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import prepare
from millrace.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""
    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(prepare(spark), str(folder)))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql.strip()
        return build

    return register


# SQL twins of the roles in sources.tables.
SALES = """sales AS (
  SELECT o_orderkey AS sale_id, CAST(o_orderdate AS DATE) AS date, strftime(o_orderdate, '%Y-%m') AS month,
         o_orderpriority AS region, o_orderstatus AS category, o_totalprice AS amount
  FROM orders)"""
USAGE = """usage AS (
  SELECT o_orderkey AS usage_id, o_custkey AS sub_id, o_orderdate AS use_dt, o_totalprice AS mb FROM orders)"""
ACTIVE = "active AS (SELECT * FROM lineitem WHERE l_returnflag = 'R')"


def total(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(c: str) -> str:
    return f"{total(c)} / NULLIF(COUNT({c}), 0)"
