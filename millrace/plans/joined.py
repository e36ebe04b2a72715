"""Joins (J1-J10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.predicates import since
from millrace.functions.scalars import money
from millrace.operators import joins as J
from millrace.operators.aggregates import heavy, rollup_totals
from millrace.plans.registry import ACTIVE, SALES, USAGE, query, total
from millrace.sources.tables import Tables, literal_table, own_name, view

# The total row's label.
ALL_LABEL = "전체"

# Tiers of the five order priorities; one has none, so the inner join drops its sales.
TIERS = [("1-URGENT", "VIP"), ("2-HIGH", "VIP"), ("3-MEDIUM", "regular"), ("5-LOW", "new"), (None, "nobody")]
_TIERS = "tiers(region, tier) AS (VALUES ('1-URGENT', 'VIP'), ('2-HIGH', 'VIP'), ('3-MEDIUM', 'regular'), ('5-LOW', 'new'), (NULL, 'nobody'))"


@query(f"WITH {SALES}, {_TIERS} SELECT s.region, amount, category, tier FROM sales s JOIN tiers t ON s.region = t.region")
def sales_tier_join(t: Tables) -> DataFrame:
    tiers = literal_table(t.spark, TIERS, "region string, tier string")
    joined = J.with_small(t.sales(), tiers, "region")
    # The key behind the amount lets a range of equal amounts be split.
    return joined.orderBy(F.desc("amount"), "sale_id").select("region", "amount", "category", "tier")


def _active_star(t: Tables) -> DataFrame:
    return J.star(t.active(), [(t.supplier, "l_suppkey", "s_suppkey"), (t.part, "l_partkey", "p_partkey")])


_STAR = "active JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"
_STAR_ROWS = f"WITH {ACTIVE} SELECT s_name, p_name, p_retailprice FROM {_STAR}"


def _star_rows(t: Tables) -> DataFrame:
    return _active_star(t).select("s_name", "p_name", "p_retailprice")


@query(_STAR_ROWS)
def active_join(t: Tables) -> DataFrame:
    # The line's own key behind the others lets a hot pair of supplier and part be split.
    ordered = _active_star(t).orderBy(F.desc("p_retailprice"), "s_name", "p_name", "l_orderkey", "l_linenumber")
    return ordered.select("s_name", "p_name", "p_retailprice")


@query(_STAR_ROWS)
def active_view(t: Tables) -> DataFrame:
    return view(_star_rows(t), own_name("returned_lines"))


@query(f"""
WITH {ACTIVE}
SELECT s_nationkey AS region, COUNT(*) AS active_lines,
       round({total('p_retailprice')} / COUNT(p_retailprice), 0) AS mean_price
FROM {_STAR} GROUP BY 1""")
def active_by_region(t: Tables) -> DataFrame:
    """Subscriptions are counted per supplier and part before either is joined."""
    counted = t.active().groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    fees = counted.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_suppkey").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("p_retailprice").isNotNull(), F.col("n"))).alias("paying"),
        F.sum(money("p_retailprice") * F.col("n")).alias("fees"),
    )
    placed = fees.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    mean_price = F.sum("fees").cast("double") / F.sum("paying")
    return (
        placed.groupBy(F.col("s_nationkey").alias("region"))
        .agg(F.sum("n").alias("active_lines"), F.round(mean_price, 0).alias("mean_price"))
        .orderBy("region")
    )


_ROLLUP = f"""
WITH {ACTIVE}, plans AS (SELECT * FROM active JOIN {{dim}})
SELECT CASE WHEN grouping({{key}}) = 1 THEN '{ALL_LABEL}' ELSE CAST({{key}} AS VARCHAR) END AS key,
       CASE WHEN grouping({{key}}) = 1 THEN '{ALL_LABEL}' ELSE MAX({{label}}) END AS label,
       COUNT(*) AS cnt, round({{fee}} / COUNT({{fee_column}}), 0) AS avg_fee
FROM plans GROUP BY ROLLUP ({{key}}) HAVING COUNT(*) >= {{least}}"""


@query(_ROLLUP.format(dim="part ON l_partkey = p_partkey", key="p_partkey", label="p_name",
                      fee=total("p_retailprice"), fee_column="p_retailprice", least=2))
def rollup_active(t: Tables) -> DataFrame:
    return rollup_totals(t.active(), "l_partkey", t.part, "p_partkey", "p_name", "p_retailprice", ALL_LABEL, 2)


@query(_ROLLUP.format(dim="supplier ON l_suppkey = s_suppkey", key="s_suppkey", label="s_name",
                      fee=total("s_acctbal"), fee_column="s_acctbal", least=200))
def having_min_count(t: Tables) -> DataFrame:
    return rollup_totals(t.active(), "l_suppkey", t.supplier, "s_suppkey", "s_name", "s_acctbal", ALL_LABEL, 200)


CUT = dt.date(2001, 1, 1)
_LATE = "o_orderdate >= DATE '2001-01-01'"


@query(f"""
SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT * FROM orders WHERE {_LATE}) ON o_custkey = c_custkey
WHERE o_orderkey IS NULL""")
def no_orders_anti(t: Tables) -> DataFrame:
    recent = t.orders.filter(since("o_orderdate", CUT))
    return J.without_match(t.customer.select("c_custkey", "c_name"), "c_custkey", recent, "o_custkey")


@query("""
SELECT p_partkey, p_name FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND l_quantity >= 45 AND l_returnflag = 'R'
WHERE l_orderkey IS NULL""")
def anti_on_pred(t: Tables) -> DataFrame:
    only = (F.col("l_quantity") >= 45) & (F.col("l_returnflag") == "R")
    return J.without_match(t.part.select("p_partkey", "p_name"), "p_partkey", t.lineitem, "l_partkey", only)


@query(f"""
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND {_LATE})""")
def exists_semi(t: Tables) -> DataFrame:
    recent = t.orders.filter(since("o_orderdate", CUT))
    return J.with_match(t.customer.select("c_custkey", "c_name"), "c_custkey", recent, "o_custkey")


@query(f"""
SELECT c_custkey, (SELECT {total('o_totalprice')} FROM orders WHERE o_custkey = c_custkey AND {_LATE}) AS total
FROM customer""")
def total_correlated(t: Tables) -> DataFrame:
    """The correlated subquery as written; Spark turns it into an aggregate and a left join."""
    parents, children = own_name("parents"), own_name("children")
    t.customer.createOrReplaceTempView(parents)
    t.orders.createOrReplaceTempView(children)
    return t.spark.sql(f"""
        SELECT c_custkey, (SELECT {total('o_totalprice')} FROM {children} WHERE o_custkey = c_custkey AND {_LATE}) AS total
        FROM {parents}""")


@query(f"""
SELECT c_custkey, {total('o_totalprice')} AS total
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND {_LATE} GROUP BY 1""")
def total_left_join(t: Tables) -> DataFrame:
    recent = t.orders.filter(since("o_orderdate", CUT))
    return J.with_total(t.customer.select("c_custkey"), "c_custkey", recent, "o_custkey", "o_totalprice")


@query(f"""
WITH {USAGE}, per AS (SELECT sub_id, {total('mb')} AS tot, SUM(CAST(mb AS DECIMAL(18,2))) AS exact FROM usage GROUP BY 1)
SELECT sub_id, tot FROM per WHERE tot > (SELECT CAST(SUM(exact) AS DOUBLE) / COUNT(*) FROM per)""")
def heavy_users(t: Tables) -> DataFrame:
    return heavy(t.usage(), "sub_id", "mb", "tot").orderBy(F.desc("tot"), "sub_id")


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status FROM orders""")
def category_lookup(t: Tables) -> DataFrame:
    named = J.looked_up(t.orders, "o_orderstatus", {"F": "finished", "O": "open"}, "status")
    return named.select("o_orderkey", "status")
