"""Filling, outliers, conversion, codes (M1-M6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import cleaning as C
from millrace.plans.registry import query
from millrace.sources.tables import Tables


def _gaps(t: Tables) -> DataFrame:
    """Events as sales with a gap now and then."""
    key = F.col("event_id")
    return t.events.select(
        key,
        F.when(key % 20 != 11, F.date_format("ts", "yyyy-MM-dd")).alias("date"),
        F.col("user_id").alias("region"),
        F.when(key % 10 != 3, F.col("value")).alias("amount"),
        F.when(key % 7 != 2, F.col("event_type")).alias("category"),
    )


_GAPS = """gaps AS (
  SELECT event_id, CASE WHEN event_id % 20 <> 11 THEN strftime(ts, '%Y-%m-%d') END AS date, user_id AS region,
         CASE WHEN event_id % 10 <> 3 THEN value END AS amount, CASE WHEN event_id % 7 <> 2 THEN event_type END AS category
  FROM events)"""
_MODE = "(SELECT category FROM gaps WHERE category IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)"
_FILLED = f"""{_GAPS}, filled AS (
  SELECT event_id, date, region, round(COALESCE(amount, (SELECT median(amount) FROM gaps)), 6) AS amount,
         COALESCE(category, {_MODE}) AS category
  FROM gaps)"""


@query(f"WITH {_FILLED} SELECT event_id, amount, category FROM filled")
def filled(t: Tables) -> DataFrame:
    out = C.fill_with_mode(C.fill_with_median(_gaps(t), "amount"), "category")
    return out.select("event_id", F.round("amount", 6).alias("amount"), "category")


def _bounds(source: str, column: str) -> str:
    return f"""bounds AS (
  SELECT q1, q3, q1 - 1.5::DOUBLE * (q3 - q1) AS low, q3 + 1.5::DOUBLE * (q3 - q1) AS high
  FROM (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM {source}))"""


_VALUE_BOUNDS = _bounds("events", "value")


@query(f"""
WITH {_VALUE_BOUNDS}
SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(low, 6) AS low, round(high, 6) AS high,
       (SELECT COUNT(*) FROM events WHERE NOT value BETWEEN low AND high) AS removed,
       (SELECT COUNT(*) FROM events WHERE value BETWEEN low AND high) AS kept
FROM bounds""")
def iqr_bounds(t: Tables) -> DataFrame:
    b = C.iqr_bounds(t.events, "value")
    inside = F.col("value").between(b["low"], b["high"])
    counts = t.events.agg(F.count_if(~inside).alias("removed"), F.count_if(inside).alias("kept"))
    return counts.select(*[F.round(F.lit(v), 6).alias(k) for k, v in b.items()], "removed", "kept")


@query(f"WITH {_VALUE_BOUNDS} SELECT event_id, value FROM events, bounds WHERE NOT value BETWEEN low AND high")
def iqr_outliers(t: Tables) -> DataFrame:
    return C.iqr_outliers(t.events.select("event_id", "value"), "value")


@query(f"WITH {_bounds('documents', 'n_chars')} SELECT doc_id, n_chars FROM documents, bounds WHERE n_chars BETWEEN low AND high")
def iqr_kept(t: Tables) -> DataFrame:
    return C.iqr_kept(t.documents.select("doc_id", "n_chars"), "n_chars")


@query("SELECT event_id, CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS day FROM events")
def strict_dates(t: Tables) -> DataFrame:
    return t.events.select("event_id", S.strict_date(F.date_format("ts", "yyyy-MM-dd")).alias("day"))


@query("""
SELECT event_id, TRY_CAST(CASE WHEN event_id % 9 = 4 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d') END AS DATE) AS day FROM events""")
def lenient_dates(t: Tables) -> DataFrame:
    text = F.when(F.col("event_id") % 9 == 4, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return t.events.select("event_id", S.lenient_date(text).alias("day"))


@query("""
WITH codes AS (SELECT brand, row_number() OVER (ORDER BY brand) - 1 AS code
               FROM (SELECT DISTINCT nullif(p_brand, 'Brand#3') AS brand FROM part) WHERE brand IS NOT NULL)
SELECT p_partkey, p_brand AS brand, CAST(COALESCE(code, -1) AS INTEGER) AS code
FROM (SELECT p_partkey, nullif(p_brand, 'Brand#3') AS p_brand FROM part) LEFT JOIN codes ON brand = p_brand""")
def category_codes(t: Tables) -> DataFrame:
    brands = t.part.select("p_partkey", F.nullif("p_brand", F.lit("Brand#3")).alias("brand"))
    return C.encoded(brands, "brand")


# Names of three of the five event types; the others have none.
NAMES = {"click": "clicked", "view": "viewed", "purchase": "bought"}


@query(f"""
WITH {_GAPS}, filled AS (
  SELECT event_id, CAST(date AS DATE) AS date, region, COALESCE(amount, (SELECT median(amount) FROM gaps)) AS amount,
         COALESCE(category, {_MODE}) AS category
  FROM gaps),
dated AS (SELECT * FROM filled WHERE date IS NOT NULL), {_bounds('dated', 'amount')}, named AS (
  SELECT event_id, date, region, round(amount, 6) AS amount, category,
         CASE category WHEN 'click' THEN 'clicked' WHEN 'view' THEN 'viewed' WHEN 'purchase' THEN 'bought' END AS category_en
  FROM dated, bounds WHERE amount BETWEEN low AND high)
SELECT *, upper(category_en) AS category_upper, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       dayname(date) AS weekday FROM named""")
def cleaned_sales(t: Tables) -> DataFrame:
    return C.cleaned_sales(_gaps(t), NAMES).withColumn("amount", F.round("amount", 6))
