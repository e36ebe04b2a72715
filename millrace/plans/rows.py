"""Projections, filters and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import predicates as P
from millrace.functions import scalars as S
from millrace.functions import udfs
from millrace.operators.ordered import numbered
from millrace.operators.paging import by
from millrace.operators.sequences import before_marker
from millrace.plans.registry import query
from millrace.sources.tables import Tables

# --- projections ---------------------------------------------------------------------------


@query("SELECT o_orderpriority AS region, o_totalprice AS amount FROM orders")
def select_columns(t: Tables) -> DataFrame:
    return t.sales().select("region", "amount")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_quantity * 1.1::DOUBLE AS adjusted,
       l_extendedprice - l_discount AS difference
FROM lineitem""")
def computed_column(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount").withColumns(
        {"adjusted": F.col("l_quantity") * 1.1, "difference": F.col("l_extendedprice") - F.col("l_discount")}
    ).drop("l_extendedprice", "l_discount")


@query("""
SELECT c_custkey, upper(c_mktsegment) AS c_mktsegment, CAST('2024-01-01' AS DATE) + CAST(c_custkey % 28 AS INTEGER) AS joined
FROM customer""")
def replaced_columns(t: Tables) -> DataFrame:
    text = F.format_string("2024-01-%02d", F.col("c_custkey") % 28 + 1)
    customers = t.customer.select("c_custkey", F.lower("c_mktsegment").alias("c_mktsegment"), text.alias("joined"))
    return customers.withColumns({"c_mktsegment": F.upper("c_mktsegment"), "joined": S.lenient_date("joined")})


@query("SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS BIGINT) AS ordinal FROM events")
def ordinal_rows(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "ts")
    placed = numbered(events, by([("ts", False), ("event_id", False)]), name="_at")
    return placed.select("event_id", (F.col("_at") - 1).alias("ordinal"))


# --- filters -------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 250000")
def amount_at_least(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").filter(P.at_least("o_totalprice", 250000))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def amount_above(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").filter(P.above("o_totalprice", 250000))


@query("""
SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate >= DATE '2000-01-01'""")
def in_list_since(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    return orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & P.since("o_orderdate", dt.date(2000, 1, 1)))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (11, 12, 25)")
def key_in_list(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey").filter(F.col("o_custkey").isin(11, 12, 25))


@query("SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 30 AND 49")
def between_range(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_size").filter(F.col("p_size").between(30, 49))


@query("""
SELECT p_partkey, nullif(p_size, 7) AS p_size FROM part
WHERE NOT COALESCE(nullif(p_size, 7) BETWEEN 30 AND 49, FALSE)""")
def outside_range(t: Tables) -> DataFrame:
    sizes = t.part.select("p_partkey", F.nullif("p_size", F.lit(7)).alias("p_size"))
    return sizes.filter(P.outside("p_size", 30, 49))


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_custkey = 24 AND o_orderdate >= '1998-01-01'")
def key_and_since(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.filter((F.col("o_custkey") == 24) & P.since("o_orderdate", dt.date(1998, 1, 1)))


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%'")
def name_prefix(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name").filter(F.col("p_name").startswith("small"))


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring'")
def name_suffix(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name").filter(F.col("p_name").endswith("ring"))


@query("SELECT doc_id, text FROM documents WHERE contains(text, 'tion')")
def keyword_search(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text").filter(P.title_contains("text", "  tion "))


@query("""
SELECT p_partkey, p_name, p_size > 25 AS done FROM part
WHERE NOT p_size > 25 AND contains(p_name, 'ring')""")
def tab_and_search(t: Tables) -> DataFrame:
    goals = t.part.select("p_partkey", "p_name", (F.col("p_size") > 25).alias("done"))
    return goals.filter(P.in_tab("done", "active")).filter(P.title_contains("p_name", "ring"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def status_equals(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderstatus").filter(F.col("o_orderstatus") == "F")


@query("""
SELECT o_orderkey, o_orderdate FROM orders
WHERE (CAST(o_orderdate AS TIMESTAMP), o_orderkey) < (TIMESTAMP '1998-03-05', 700)""")
def before_key(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderdate")
    order = [("o_orderdate", True), ("o_orderkey", True)]
    return orders.filter(P.past_key(order, [F.lit(dt.date(1998, 3, 5)), F.lit(700)], with_nulls=False))


_GAPS = """(SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment,
  CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance FROM customer)"""


def _gaps(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
    )


@query(f"SELECT * FROM {_GAPS} WHERE segment IS NULL")
def null_rows(t: Tables) -> DataFrame:
    return _gaps(t).filter(F.col("segment").isNull())


@query(f"SELECT * FROM {_GAPS} WHERE segment IS NOT NULL AND balance IS NOT NULL")
def drop_null_rows(t: Tables) -> DataFrame:
    return _gaps(t).na.drop(subset=["segment", "balance"])


@query(r"""
SELECT page_id FROM pages
WHERE regexp_matches(html, '^[^\n]+\n?$') AND regexp_matches(html, '[a-z]') AND regexp_matches(html, '[A-Z]')
  AND regexp_matches(html, '\p{Nd}') AND regexp_matches(html, '[^a-zA-Z0-9]')""")
def char_classes(t: Tables) -> DataFrame:
    return t.pages.filter(P.has_all_classes("html")).select("page_id")


@query("""
SELECT o_orderkey FROM orders
WHERE o_orderdate IS NOT NULL AND NOT o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) < DATE '1998-01-01'""")
def overdue(t: Tables) -> DataFrame:
    goals = t.orders.withColumn("done", F.col("o_orderstatus") == "F")
    return goals.filter(P.overdue("o_orderdate", "done", dt.date(1998, 1, 1))).select("o_orderkey")


@query("""
SELECT c.conv_id, c.turn, c.role FROM conversations c
LEFT JOIN (SELECT conv_id, MIN(turn) AS stop FROM conversations WHERE role = 'assistant' GROUP BY 1) s USING (conv_id)
WHERE s.stop IS NULL OR c.turn < s.stop""")
def until_sentinel(t: Tables) -> DataFrame:
    turns = t.conversations.select("conv_id", "turn", "role")
    return before_marker(turns, "conv_id", "turn", F.col("role") == "assistant")


@query("SELECT doc_id FROM labels WHERE NOT (toxic = 1)")
def not_flag(t: Tables) -> DataFrame:
    return t.labels.filter(~F.coalesce(F.col("toxic") == 1, F.lit(False))).select("doc_id")


@query("SELECT * FROM orders WHERE o_orderkey = 42")
def by_id(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderkey") == 42)


@query("SELECT * FROM customer WHERE c_custkey <> 42")
def without_id(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_custkey") != 42)


@query("SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def without_ids(t: Tables) -> DataFrame:
    return t.documents.join(t.labels.select("doc_id").distinct(), "doc_id", "left_anti")


# --- rewrites that reach the scan ------------------------------------------------------------

_YEAR = "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1997"


@query(_YEAR)
def year_wrapped(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate").filter(F.year("o_orderdate") == 1997)


@query(_YEAR)
def year_range(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate").filter(P.in_year("o_orderdate", 1997))


@query("SELECT event_id, ts FROM events WHERE strftime(ts, '%Y-%m-%d') = '2024-01-03'")
def day_range(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts").filter(P.on_day("ts", dt.date(2024, 1, 3)))


# --- scalar functions ------------------------------------------------------------------------

AS_OF = dt.date(2046, 2, 28)


@query("""
WITH a AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS born,
         CAST(2046 - year(o_orderdate) - CASE WHEN '0228' < strftime(o_orderdate, '%m%d') THEN 1 ELSE 0 END AS INTEGER) AS age
  FROM orders)
SELECT o_orderkey, born, age,
       CASE WHEN age < 46 THEN '청년' WHEN age BETWEEN 46 AND 49 THEN '중년' ELSE '장년' END AS age_group
FROM a""")
def ages(t: Tables) -> DataFrame:
    people = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("born"))
    return people.withColumn("age", S.whole_years("born", F.lit(AS_OF))).withColumn(
        "age_group", S.age_group("age", young_below=46, middle_to=49)
    )


@query("""
SELECT c_custkey, COALESCE(nullif(c_mktsegment, 'BUILDING'), '미상') AS region,
       round(c_acctbal, 0) AS whole, round(CAST(c_acctbal AS DECIMAL(18,2)), -3)::DOUBLE AS thousands,
       CAST(c_custkey AS VARCHAR) AS key_text, format('{:,}', CAST(round(c_acctbal) AS BIGINT)) AS pretty,
       CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(18,1)) AS VARCHAR) AS one_place
FROM customer""")
def number_forms(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey",
        F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit(S.UNKNOWN_REGION)).alias("region"),
        F.round(balance, 0).alias("whole"),
        F.round(S.money(balance), -3).cast("double").alias("thousands"),
        F.col("c_custkey").cast("string").alias("key_text"),
        S.with_thousands(F.round(balance).cast("bigint")).alias("pretty"),
        S.money(balance).cast("decimal(18,1)").cast("string").alias("one_place"),
    )


@query("""
SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('month', ts)::DATE AS month, strftime(ts, '%Y-%m') AS month_text,
       strftime(ts, '%Y-%m-%d') AS day_text, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m,
       dayname(ts) AS weekday, CAST(ts AS DATE) - 3 AS before
FROM events""")
def date_forms(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        S.utc_day("ts").alias("day"),
        S.month_start("ts").alias("month"),
        S.month_text("ts").alias("month_text"),
        S.day_text("ts").alias("day_text"),
        F.year("ts").alias("y"),
        F.month("ts").alias("m"),
        S.weekday_name("ts").alias("weekday"),
        F.date_sub(S.utc_day("ts"), 3).alias("before"),
    )


@query("SELECT doc_id, string_split_regex(text, '\\r\\n|\\r|\\n')[1] AS line FROM documents")
def first_line(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", S.first_line("text").alias("line"))


@query("""
SELECT page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(160), '&nbsp;') AS safe
FROM pages""")
def html_escape(t: Tables) -> DataFrame:
    return t.pages.select("page_id", S.html_escaped("html").alias("safe"))


@query(r"""
SELECT conv_id, turn, trim(concat(chr(9), ' ', text, chr(10), ' '), E' \t\r\n') AS text FROM conversations""")
def trimmed_text(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("\t "), "text", F.lit("\n "))
    return t.conversations.select("conv_id", "turn", S.trimmed(padded).alias("text"))


@query("""
SELECT o_orderkey, list_extract(['one', 'two', 'three', 'four', 'five', 'six', 'seven'], day(o_orderdate) % 7 + 1) AS tip
FROM orders""")
def tip_of_day(t: Tables) -> DataFrame:
    tips = F.array(*[F.lit(x) for x in ("one", "two", "three", "four", "five", "six", "seven")])
    return t.orders.select("o_orderkey", S.rotating_pick(tips, "o_orderdate").alias("tip"))


@query("""
SELECT user_id, CAST(COUNT(*) AS BIGINT) AS n, CAST(LEAST(COUNT(*), 3) AS INTEGER) AS level,
       concat('user ', user_id, ' · ', COUNT(*), ' events') AS line
FROM events GROUP BY user_id""")
def summary_text(t: Tables) -> DataFrame:
    counts = t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    line = F.concat_ws(" · ", F.format_string("user %d", "user_id"), F.format_string("%d events", "n"))
    return counts.select("user_id", "n", S.activity_level("n").alias("level"), line.alias("line"))


@query("SELECT doc_id, replace(text, ' ', '') AS joined FROM documents")
def joined_words(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.array_join(F.split("text", " "), "").alias("joined"))


# --- upper case in three forms -----------------------------------------------------------------

_UPPER = """
SELECT l_orderkey, l_linenumber, upper('line ' || l_linenumber || ' of ' || lower(l_returnflag) || lower(l_linestatus)) AS name
FROM lineitem"""


def _line_names(t: Tables, upper) -> DataFrame:
    name = F.concat(F.lit("line "), "l_linenumber", F.lit(" of "), F.lower("l_returnflag"), F.lower("l_linestatus"))
    return t.lineitem.select("l_orderkey", "l_linenumber", upper(name).alias("name"))


@query(_UPPER)
def upper_row(t: Tables) -> DataFrame:
    return _line_names(t, udfs.upper_per_row)


@query(_UPPER)
def upper_vector(t: Tables) -> DataFrame:
    return _line_names(t, udfs.upper_per_batch)


@query(_UPPER)
def upper_native(t: Tables) -> DataFrame:
    return _line_names(t, udfs.upper_native)


@query("SELECT COUNT(*) AS n, TRUE AS same FROM documents")
def forms_agree(t: Tables) -> DataFrame:
    texts = t.documents.select(
        udfs.upper_per_row("text").alias("a"), udfs.upper_per_batch("text").alias("b"), udfs.upper_native("text").alias("c")
    )
    return texts.agg(F.count("*").alias("n"), F.every(F.col("a").eqNullSafe(F.col("b")) & F.col("b").eqNullSafe(F.col("c"))).alias("same"))
