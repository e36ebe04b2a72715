"""Window functions, sorting, top-k and pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import money_sum, month_start
from millrace.operators import paging as L
from millrace.operators import windows as W
from millrace.plans.registry import USAGE, query
from millrace.sources.tables import Tables

_MONTHLY = f"""{USAGE}, monthly AS (
  SELECT sub_id, date_trunc('month', use_dt)::DATE AS month, SUM(CAST(mb AS DECIMAL(18,2))) AS total FROM usage GROUP BY 1, 2)"""


def _monthly(t: Tables) -> DataFrame:
    return W.monthly_totals(t.usage(), "sub_id", "use_dt", "mb")


@query(f"""
WITH {_MONTHLY}
SELECT sub_id, month, CAST(total AS DOUBLE) AS total,
       row_number() OVER (PARTITION BY month ORDER BY total DESC, sub_id) AS position FROM monthly""")
def month_positions(t: Tables) -> DataFrame:
    return W.numbered_in_month(_monthly(t), "sub_id").withColumn("total", F.col("total").cast("double"))


@query(f"""
WITH {_MONTHLY}
SELECT sub_id, month, CAST(total AS DOUBLE) AS total,
       CAST(total - lag(total) OVER (PARTITION BY sub_id ORDER BY month) AS DOUBLE) AS change,
       CAST(SUM(total) OVER (PARTITION BY sub_id ORDER BY month) AS DOUBLE) AS so_far FROM monthly""")
def monthly_history(t: Tables) -> DataFrame:
    history = W.with_history(_monthly(t), "sub_id")
    return history.withColumns({c: F.col(c).cast("double") for c in ("total", "change", "so_far")})


_FALLING = "OVER (PARTITION BY month ORDER BY mb_rounded DESC)"


@query(f"""
WITH {USAGE}, m AS (
  SELECT sub_id, date_trunc('month', use_dt)::DATE AS month, CAST(round(SUM(CAST(mb AS DECIMAL(18,2))), -3) AS DOUBLE) AS mb_rounded
  FROM usage GROUP BY 1, 2)
SELECT sub_id, month, mb_rounded, CAST(rank() {_FALLING} AS INTEGER) AS rnk, CAST(dense_rank() {_FALLING} AS INTEGER) AS dense_rnk
FROM m WHERE month = DATE '1998-08-01' ORDER BY mb_rounded DESC, sub_id LIMIT 8""")
def rank_and_dense(t: Tables) -> DataFrame:
    """The month is filtered before the sum, on the date itself."""
    august = t.usage().filter(
        (F.col("use_dt") >= F.lit(dt.date(1998, 8, 1))) & (F.col("use_dt") < F.lit(dt.date(1998, 9, 1)))
    )
    rounded = august.groupBy("sub_id", month_start("use_dt").alias("month")).agg(
        F.round(money_sum("mb"), -3).cast("double").alias("mb_rounded")
    )
    return W.ranked_top(rounded, "mb_rounded", "sub_id", 8)


# --- sorting -----------------------------------------------------------------------------

@query("SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, c_acctbal FROM customer")
def sorted_rows(t: Tables) -> DataFrame:
    customers = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_acctbal")
    return customers.orderBy(*L.by([("segment", False), ("c_acctbal", True), ("c_custkey", False)]))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 15")
def first_rows(t: Tables) -> DataFrame:
    return L.top(t.customer.select("c_custkey", "c_name", "c_acctbal"), [("c_acctbal", False), ("c_custkey", False)], 15)


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(ts AS DATE) END AS due FROM events")
def due_order(t: Tables) -> DataFrame:
    """Earliest due date first, rows without one last."""
    goals = t.events.select("event_id", F.when(F.col("event_id") % 2 == 0, F.to_date("ts")).alias("due"))
    return goals.orderBy(*L.by([("due", False), ("event_id", False)]))


@query("SELECT event_id, ts FROM events")
def newest_first(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts").orderBy(*L.by([("event_id", True)]))


# --- pages ---------------------------------------------------------------------------------

NEWEST = [("use_dt", True), ("usage_id", True)]
OFFSET, PAGE = 1_000, 20
_PAGE = f"WITH {USAGE} SELECT * FROM usage ORDER BY use_dt DESC, usage_id DESC LIMIT {PAGE} OFFSET {OFFSET}"


@query(_PAGE)
def offset_page(t: Tables) -> DataFrame:
    return L.offset_page(t.usage(), NEWEST, OFFSET, PAGE)


@query(f"WITH {USAGE} SELECT use_dt, usage_id FROM usage ORDER BY use_dt DESC, usage_id DESC LIMIT 1 OFFSET {OFFSET - 1}")
def page_boundary(t: Tables) -> DataFrame:
    key = L.page_boundary(t.usage(), NEWEST, OFFSET)
    rows = [tuple(key)] if key else []
    return t.spark.createDataFrame(rows, "use_dt timestamp_ntz, usage_id bigint")


# A row that was the last of the page before, as a reader of pages would pass it on.
SEEN = [dt.datetime(2001, 2, 10), 500]


@query(f"""
WITH {USAGE} SELECT * FROM usage WHERE (use_dt, usage_id) < (TIMESTAMP '2001-02-10', 500)
ORDER BY use_dt DESC, usage_id DESC LIMIT {PAGE}""")
def keyset_page(t: Tables) -> DataFrame:
    return L.keyset_page(t.usage(), NEWEST, SEEN, PAGE)


# Keys with nulls, text keys, and first pages that are longer than a screen.
NULLABLE = [("balance", True), ("c_custkey", False)]
_BALANCES = "(SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN c_acctbal END AS balance FROM customer)"


@query(f"SELECT * FROM {_BALANCES} ORDER BY balance DESC NULLS LAST, c_custkey LIMIT 40 OFFSET 110")
def page_null_keys(t: Tables) -> DataFrame:
    """A page that ends among the rows without a key."""
    balances = t.customer.select("c_custkey", F.when(F.col("c_acctbal") > 9000, F.col("c_acctbal")).alias("balance"))
    return L.offset_page(balances, NULLABLE, 110, 40)


@query("SELECT p_name, p_partkey FROM part ORDER BY p_name, p_partkey LIMIT 25 OFFSET 170")
def page_text_key(t: Tables) -> DataFrame:
    return L.offset_page(t.part.select("p_name", "p_partkey"), [("p_name", False), ("p_partkey", False)], 170, 25)


@query(f"WITH {USAGE} SELECT * FROM usage ORDER BY use_dt DESC, usage_id DESC LIMIT 300")
def first_page_long(t: Tables) -> DataFrame:
    return L.offset_page(t.usage(), NEWEST, 0, 300)
