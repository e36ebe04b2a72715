"""Aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.functions.predicates import in_year
from millrace.operators import aggregates as A
from millrace.operators.order_stats import exact_quantiles
from millrace.operators.paging import numbered_top, top
from millrace.plans.registry import SALES, USAGE, mean, query, total
from millrace.sources.tables import Tables

# --- per key -----------------------------------------------------------------------------

_HIGH = f"SELECT region, {total('amount')} AS total FROM sales WHERE amount >= 250000 GROUP BY region"


def _high(t: Tables) -> DataFrame:
    return A.sum_by(t.sales().filter(F.col("amount") >= 250000), ["region"], "amount")


@query(f"WITH {SALES} {_HIGH}")
def sum_by_region_high(t: Tables) -> DataFrame:
    return _high(t)


@query(f"WITH {SALES} SELECT region, COUNT(*) AS n FROM sales GROUP BY region")
def count_by_region(t: Tables) -> DataFrame:
    """Keys by frequency, most frequent first."""
    return A.count_by(t.sales(), ["region"]).orderBy(F.desc("n"), "region")


PIECE = 1_000


@query(f"""
WITH {SALES}, numbered AS (
  SELECT category, amount, row_number() OVER (PARTITION BY category ORDER BY sale_id) - 1 AS place FROM sales)
SELECT category, place // {PIECE} AS piece,
       string_agg(CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), ',' ORDER BY place) AS amounts
FROM numbered GROUP BY 1, 2""")
def amounts_by_category(t: Tables) -> DataFrame:
    lists = A.lists_by(t.sales(), "category", S.money("amount"), [F.col("sale_id")], PIECE, "amounts")
    texts = F.transform("amounts", lambda x: x.cast("string"))
    return lists.select("category", "piece", F.array_join(texts, ",").alias("amounts"))


@query(f"WITH {SALES} SELECT category, COUNT(*) AS n FROM sales GROUP BY 1")
def list_sizes(t: Tables) -> DataFrame:
    lists = A.lists_by(t.sales(), "category", S.money("amount"), [F.col("sale_id")], PIECE, "amounts")
    return A.list_sizes(lists, "category", "amounts")


_MONTHS = f"SELECT month, category, {total('amount')} AS total FROM sales GROUP BY 1, 2"


@query(f"WITH {SALES} {_MONTHS}")
def sum_month_category(t: Tables) -> DataFrame:
    return A.sum_by(t.sales(), ["month", "category"], "amount")


_SALES_BY_REGION = f"""
WITH {SALES}
SELECT region, {total('amount')} AS total, {mean('amount')} AS avg, COUNT(*) AS cnt
FROM sales WHERE amount > 0 GROUP BY region"""


@query(_SALES_BY_REGION)
def sales_by_region(t: Tables) -> DataFrame:
    """Sum, mean and count per region, largest total first."""
    return A.totals_by(t.sales().filter(F.col("amount") > 0), ["region"], "amount").orderBy(F.desc("total"), "region")


@query(f"""
WITH {SALES}
SELECT category, {total('amount')} AS total, COUNT(*) AS cnt
FROM sales WHERE region = '2-HIGH' AND amount > 0 GROUP BY category""")
def lazy_by_category(t: Tables) -> DataFrame:
    return (
        t.sales()
        .filter(F.col("region") == "2-HIGH")
        .filter(F.col("amount") > 0)
        .groupBy("category")
        .agg(S.money_sum("amount").cast("double").alias("total"), F.count("*").alias("cnt"))
        .orderBy(F.desc("total"), "category")
    )


@query(f"WITH {SALES} SELECT DISTINCT region FROM sales")
def distinct_regions(t: Tables) -> DataFrame:
    return t.sales().select("region").distinct()


@query(f"""
WITH {SALES}
SELECT COUNT(*) FILTER (region = '2-HIGH') AS n, CAST(SUM(CASE WHEN region = '2-HIGH' THEN CAST(amount AS DECIMAL(18,2)) END) AS DOUBLE) AS total,
       COUNT(*) FILTER (NOT amount BETWEEN 100000 AND 300000) AS outside
FROM sales""")
def conditional_totals(t: Tables) -> DataFrame:
    chosen = F.col("region") == "2-HIGH"
    return t.sales().agg(
        F.count_if(chosen).alias("n"),
        S.money_sum(F.when(chosen, F.col("amount"))).cast("double").alias("total"),
        F.count_if(~F.col("amount").between(100000, 300000)).alias("outside"),
    )


@query("SELECT COUNT(*) AS n FROM lineitem")
def table_count(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n"))


@query("""
SELECT event_id // 1000 AS chunk, CAST(CAST(SUM(CAST(event_id AS HUGEINT) * event_id) AS HUGEINT) AS VARCHAR) AS squares
FROM events GROUP BY 1""")
def sum_of_squares(t: Tables) -> DataFrame:
    chunk = F.floor(F.col("event_id") / 1000).cast("bigint")
    return A.sum_of_squares(t.events, "event_id", chunk).withColumn("squares", F.col("squares").cast("string"))


# --- per key and time --------------------------------------------------------------------

@query(f"""
WITH {USAGE}
SELECT strftime(use_dt, '%Y-%m') AS ym, {total('mb')} AS total FROM usage
WHERE use_dt >= '1997-01-01' AND use_dt < '1998-01-01' GROUP BY 1""")
def sum_by_month_text(t: Tables) -> DataFrame:
    """Grouped by the month itself and turned into text afterwards, once per group."""
    months = t.usage().filter(in_year("use_dt", 1997)).groupBy(S.month_start("use_dt").alias("m"))
    return months.agg(S.money_sum("mb").cast("double").alias("total")).orderBy("m").select(
        S.month_text("m").alias("ym"), "total"
    )


@query(f"WITH {USAGE} SELECT sub_id, date_trunc('month', use_dt)::DATE AS month, {total('mb')} AS total FROM usage GROUP BY 1, 2")
def sum_by_key_month(t: Tables) -> DataFrame:
    return t.usage().groupBy("sub_id", S.month_start("use_dt").alias("month")).agg(
        S.money_sum("mb").cast("double").alias("total")
    )


@query(f"WITH {USAGE} SELECT sub_id, {total('mb')} AS total FROM usage WHERE year(use_dt) = 1997 GROUP BY 1")
def annual_totals(t: Tables) -> DataFrame:
    year = t.usage().filter(in_year("use_dt", 1997))
    return A.sum_by(year, ["sub_id"], "mb").orderBy(F.desc("total"), "sub_id")


# --- top groups --------------------------------------------------------------------------

@query(f"""
WITH {SALES}
SELECT CAST(row_number() OVER (ORDER BY total DESC, region) AS INTEGER) AS position, region, total
FROM ({_HIGH}) ORDER BY 1 LIMIT 3""")
def top3_regions(t: Tables) -> DataFrame:
    return numbered_top(_high(t), [("total", True), ("region", False)], 3)


@query(f"""
WITH {SALES}
SELECT month, category, total FROM ({_MONTHS}) ORDER BY total DESC, month, category LIMIT 3""")
def top3_months(t: Tables) -> DataFrame:
    return top(sum_month_category(t), [("total", True), ("month", False), ("category", False)], 3)


@query(f"""
WITH {SALES}
SELECT (SELECT MAX(total) FROM ({_MONTHS})) AS largest, total AS first, TRUE AS same
FROM ({_MONTHS}) ORDER BY total DESC LIMIT 1""")
def top_equals_max(t: Tables) -> DataFrame:
    return A.largest_total(sum_month_category(t), "total")


@query(f"""
WITH {SALES}, groups AS ({_MONTHS})
SELECT {total('amount')} AS whole, (SELECT {total('total')} FROM groups) AS parts,
       COUNT(*) AS n, (SELECT CAST(SUM(n) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM sales GROUP BY region)) AS counted
FROM sales""")
def sums_agree(t: Tables) -> DataFrame:
    """The grand total and count next to the sums over the groups."""
    parts = A.sum_by(t.sales(), ["month", "category"], "amount").agg(S.money_sum("total").cast("double"))
    counted = A.count_by(t.sales(), ["region"]).agg(F.sum("n"))
    return t.sales().agg(S.money_sum("amount").cast("double").alias("whole"), F.count("*").alias("n")).select(
        "whole", parts.scalar().alias("parts"), "n", counted.scalar().alias("counted")
    )


# --- descriptive -------------------------------------------------------------------------

@query("SELECT CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value) AS mean FROM events")
def mean_value(t: Tables) -> DataFrame:
    return t.events.agg(S.average("value").alias("mean"))


def _quantile_row(t: Tables, values: dict[str, float]) -> DataFrame:
    return t.spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} double" for k in values))


@query("SELECT round(median(value), 6) AS median FROM events")
def median_value(t: Tables) -> DataFrame:
    [median] = exact_quantiles(t.events, {"value": [0.5]})["value"]
    return _quantile_row(t, {"median": median}).select(F.round("median", 6).alias("median"))


@query("""
SELECT round(quantile_cont(value, 0.25), 6) AS value_q1, round(quantile_cont(value, 0.75), 6) AS value_q3,
       round(quantile_cont(event_id, 0.9), 6) AS id_p90 FROM events""")
def quantiles(t: Tables) -> DataFrame:
    found = exact_quantiles(t.events, {"value": [0.25, 0.75], "event_id": [0.9]})
    row = _quantile_row(t, {"value_q1": found["value"][0], "value_q3": found["value"][1], "id_p90": found["event_id"][0]})
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


@query("SELECT props, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def mode_value(t: Tables) -> DataFrame:
    return A.mode_of(t.events, "props")


_DESCRIBED = """SELECT '{c}' AS "column", COUNT({c}) AS cnt, round(AVG({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  CAST(MIN({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6)::DOUBLE AS q1, round(median({c}), 6)::DOUBLE AS median,
  round(quantile_cont({c}, 0.75), 6)::DOUBLE AS q3, CAST(MAX({c}) AS DOUBLE) AS max FROM {t}"""


@query(" UNION ALL ".join(_DESCRIBED.format(c=c, t="events") for c in ("event_id", "user_id", "value")))
def describe_numeric(t: Tables) -> DataFrame:
    return A.describe_numeric(t.events, ["event_id", "user_id", "value"])


_TOP = """SELECT '{c}' AS "column", CAST(SUM(n) AS BIGINT) AS cnt, COUNT(*) AS uniq,
  (SELECT {c} FROM events GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS top, MAX(n) AS freq
  FROM (SELECT {c}, COUNT(*) AS n FROM events GROUP BY 1)"""


@query(" UNION ALL ".join(_TOP.format(c=c) for c in ("event_type", "props")))
def describe_text(t: Tables) -> DataFrame:
    return A.describe_text(t.events, ["event_type", "props"])


_GAPS = """(SELECT nullif(event_type, 'click') AS kind, CASE WHEN value > 5 THEN value END AS value, user_id FROM events)"""


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS nulls, (COUNT(*) - COUNT({c})) * 100.0::DOUBLE / COUNT(*) AS pct FROM {_GAPS}"""
    for c in ("kind", "value", "user_id")))
def null_share(t: Tables) -> DataFrame:
    gaps = t.events.select(
        F.nullif("event_type", F.lit("click")).alias("kind"), F.when(F.col("value") > 5, F.col("value")).alias("value"), "user_id"
    )
    return A.null_report(gaps, ["kind", "value", "user_id"])


_TYPES = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")]


@query(" UNION ALL ".join(
    f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS "column", '{k}' AS type, COUNT({c}) AS filled, COUNT(*) AS rows FROM events"""
    for i, (c, k) in enumerate(_TYPES)))
def shape_report(t: Tables) -> DataFrame:
    return A.shape_report(t.events)


# --- progress ----------------------------------------------------------------------------

@query("""
SELECT COUNT(*) AS total, COUNT(*) FILTER (o_orderstatus = 'F') AS done,
       CAST(round(100.0 * COUNT(*) FILTER (o_orderstatus = 'F') / COUNT(*)) AS BIGINT) AS pct FROM orders""")
def progress(t: Tables) -> DataFrame:
    return A.progress(t.orders, F.col("o_orderstatus") == "F")


CATEGORIES = ["1-URGENT", "2-HIGH", "9-NEVER"]


@query("""
SELECT position, category, COALESCE(n, 0) AS n
FROM (VALUES (0, '1-URGENT'), (1, '2-HIGH'), (2, '9-NEVER')) AS c(position, category)
LEFT JOIN (SELECT o_orderpriority AS category, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1) USING (category)""")
def remaining_by_category(t: Tables) -> DataFrame:
    return A.remaining_by(t.orders, "o_orderpriority", F.col("o_orderstatus") == "F", CATEGORIES)


@query("""
SELECT string_agg(category || ' ' || COALESCE(n, 0), ' · ' ORDER BY position) AS line
FROM (VALUES (0, '1-URGENT'), (1, '2-HIGH'), (2, '9-NEVER')) AS c(position, category)
LEFT JOIN (SELECT o_orderpriority AS category, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1) USING (category)""")
def remaining_line(t: Tables) -> DataFrame:
    """The listed categories in one line of text; the list has as many parts as CATEGORIES."""
    counts = remaining_by_category(t)
    part = F.struct("position", F.concat_ws(" ", "category", "n").alias("text"))
    return counts.agg(F.array_join(F.array_sort(F.collect_list(part))["text"], " · ").alias("line"))


@query("""
SELECT l_returnflag, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) * CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS total
FROM lineitem GROUP BY 1""")
def sum_of_six_places(t: Tables) -> DataFrame:
    """Amounts finer than a cent, added without rounding any of them."""
    fine = F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax")
    return t.lineitem.groupBy("l_returnflag").agg(S.money_sum(fine, 6).cast("double").alias("total"))


@query("""
SELECT o_orderstatus, SUM(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE / COUNT(*) AS avg, COUNT(*) AS cnt
FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1""")
def mean_of_present(t: Tables) -> DataFrame:
    """Every fifth amount is NaN or null and takes no part in the mean."""
    key = F.col("o_orderkey")
    gaps = F.when(key % 10 == 0, F.lit(float("nan"))).when(key % 5 != 0, F.col("o_totalprice"))
    amounts = t.orders.select("o_orderstatus", gaps.alias("amount"))
    return amounts.groupBy("o_orderstatus").agg(S.average("amount").alias("avg"), F.count_if(F.col("amount").isNotNull() & ~F.isnan("amount")).alias("cnt"))
