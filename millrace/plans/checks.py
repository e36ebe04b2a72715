"""Validation, keys, dependencies and narrow tables."""

from __future__ import annotations

import datetime as dt
import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import predicates as P
from millrace.operators import dependencies as D
from millrace.operators import quality as Q
from millrace.plans.registry import query
from millrace.scratch import written
from millrace.sources.tables import Tables


def _records(t: Tables) -> DataFrame:
    """Customers as sales records: one field blanked, one missing and one not a number now and then."""
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("row"),
        F.when(key % 50 == 7, "").otherwise(F.col("c_mktsegment")).alias("region"),
        F.when(key % 60 != 11, F.col("c_name")).alias("month"),
        F.when(key % 70 == 13, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")).alias("amount"),
        F.lit(None).cast("string").alias("category"),
    )


_RECORDS = """records AS (
  SELECT c_custkey AS row, CASE WHEN c_custkey % 50 = 7 THEN '' ELSE c_mktsegment END AS region,
         CASE WHEN c_custkey % 60 <> 11 THEN c_name END AS month,
         CASE WHEN c_custkey % 70 = 13 THEN NULL ELSE c_acctbal END AS amount
  FROM customer),
judged AS (
  SELECT *, COALESCE(length(region) >= 1, FALSE) AS a, COALESCE(length(month) >= 1, FALSE) AS b,
         COALESCE(amount > 0, FALSE) AS c FROM records)"""


@query(f"WITH {_RECORDS} SELECT row, region, month, amount FROM judged WHERE a AND b AND c")
def validate_valid(t: Tables) -> DataFrame:
    valid = Q.valid_rows(Q.judged(_records(t), Q.sales_rules()))
    return valid.select("row", "region", "month", F.col("amount").cast("double").alias("amount"))


@query(f"""
WITH {_RECORDS}
SELECT row, concat_ws('; ', CASE WHEN NOT a THEN 'region: must be text of at least 1 character' END,
       CASE WHEN NOT b THEN 'month: must be text of at least 1 character' END,
       CASE WHEN NOT c THEN 'amount: must be a number greater than 0' END) AS error
FROM judged WHERE NOT (a AND b AND c)""")
def validate_errors(t: Tables) -> DataFrame:
    return Q.error_rows(Q.judged(_records(t), Q.sales_rules()), "row")


@query(f"""
WITH {_RECORDS}
SELECT COUNT(*) AS whole, COUNT(*) FILTER (a AND b AND c) AS valid, COUNT(*) FILTER (NOT (a AND b AND c)) AS errors,
       TRUE AS agrees FROM judged""")
def reconcile_counts(t: Tables) -> DataFrame:
    # The rows are judged once and then counted three times.
    checked = written(Q.judged(_records(t), Q.sales_rules()), "judged")
    return Q.reconciled(checked, {"valid": Q.valid_rows(checked), "errors": Q.error_rows(checked, "row")})


@query("SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def pk_duplicates(t: Tables) -> DataFrame:
    return Q.key_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
SELECT o_custkey, COUNT(*) AS n FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1""")
def fk_orphans(t: Tables) -> DataFrame:
    parents = t.customer.filter(F.col("c_mktsegment") != "BUILDING")
    return Q.orphans(t.orders, "o_custkey", parents, "c_custkey")


@query("""
SELECT 'region' AS "column", COUNT(*) FILTER (region IS NULL) AS nulls FROM records
UNION ALL SELECT 'month', COUNT(*) FILTER (month IS NULL) FROM records
UNION ALL SELECT 'row', COUNT(*) FILTER (row IS NULL) FROM records""".replace("FROM records", f"FROM (WITH {_RECORDS} SELECT * FROM records)"))
def null_counts(t: Tables) -> DataFrame:
    return Q.null_counts(_records(t), ["region", "month", "row"])


@query("""
SELECT l_orderkey, l_linenumber, COUNT(DISTINCT (l_partkey, l_suppkey)) AS n
FROM lineitem GROUP BY 1, 2 HAVING COUNT(DISTINCT (l_partkey, l_suppkey)) > 1""")
def fd_violations(t: Tables) -> DataFrame:
    return Q.dependency_violations(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


# --- one wide table and its narrow tables ----------------------------------------------------

# What depends on a line, on its order, on a customer and on a part.
LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
ORDERS = ["l_orderkey", "o_custkey", "o_orderdate"]
CUSTOMERS = ["o_custkey", "c_name"]
PARTS = ["l_partkey", "p_name", "p_retailprice"]
WIDE = list(dict.fromkeys(LINES + ORDERS + CUSTOMERS + PARTS))


def _with_parents(lines: DataFrame, orders: DataFrame, customers: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines with their part and orders with their customer, so that the join of the two is the only one of wide rows."""
    return (
        Q.rejoined(lines, [(parts, "l_partkey")], [*LINES, *PARTS[1:]]),
        Q.rejoined(orders, [(customers, "o_custkey")], [*ORDERS, *CUSTOMERS[1:]]),
    )


def _wide(t: Tables) -> DataFrame:
    """Every order line with all about its order, customer and part."""
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")
    lines, orders = _with_parents(t.lineitem.select(*LINES), orders, customers, parts)
    return Q.rejoined(lines, [(orders, "l_orderkey")], WIDE)


_WIDE = f"""wide AS (
  SELECT {', '.join(WIDE)}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey)"""


@query(f"WITH {_WIDE} SELECT * FROM wide")
def four_way_join(t: Tables) -> DataFrame:
    return _wide(t)


@query(f"WITH {_WIDE} SELECT DISTINCT {', '.join(LINES)} FROM wide")
def normalised_items(t: Tables) -> DataFrame:
    return Q.split_tables(_wide(t), {"lines": LINES})["lines"]


@query(f"WITH {_WIDE} SELECT DISTINCT {', '.join(ORDERS)} FROM wide")
def normalised_orders(t: Tables) -> DataFrame:
    return Q.split_tables(_wide(t), {"orders": ORDERS})["orders"]


@query(f"WITH {_WIDE} SELECT DISTINCT {', '.join(CUSTOMERS)} FROM wide")
def normalised_customers(t: Tables) -> DataFrame:
    return Q.split_tables(_wide(t), {"customers": CUSTOMERS})["customers"]


@query(f"WITH {_WIDE} SELECT DISTINCT {', '.join(PARTS)} FROM wide")
def normalised_products(t: Tables) -> DataFrame:
    return Q.split_tables(_wide(t), {"parts": PARTS})["parts"]


@query(f"""
WITH {_WIDE}, back AS (
  SELECT {', '.join(WIDE)}
  FROM (SELECT DISTINCT {', '.join(LINES)} FROM wide) JOIN (SELECT DISTINCT {', '.join(ORDERS)} FROM wide) USING (l_orderkey)
  JOIN (SELECT DISTINCT {', '.join(CUSTOMERS)} FROM wide) USING (o_custkey)
  JOIN (SELECT DISTINCT {', '.join(PARTS)} FROM wide) USING (l_partkey))
SELECT COUNT(*) AS different, COUNT(*) = 0 AS same
FROM ((SELECT * FROM wide EXCEPT ALL SELECT * FROM back) UNION ALL (SELECT * FROM back EXCEPT ALL SELECT * FROM wide))""")
def lossless_rejoin(t: Tables) -> DataFrame:
    # Five readers follow, so the join is done once.
    wide = written(_wide(t), "wide")
    n = Q.split_tables(wide, {"lines": LINES, "orders": ORDERS, "customers": CUSTOMERS, "parts": PARTS})
    lines, orders = _with_parents(n["lines"], n["orders"], n["customers"], n["parts"])
    return Q.counted_differences(Q.rejoined_differences(wide, lines, orders, "l_orderkey"))


def _sets(most: int) -> list[tuple[str, ...]]:
    return [own for level in range(most + 1) for own in itertools.combinations(WIDE, level)]


def _distinct(own: tuple[str, ...]) -> str:
    """SQL for the number of distinct values of a set of columns, nulls included."""
    ordered = [c for c in WIDE if c in own]
    return f"d_{'_'.join(str(WIDE.index(c)) for c in ordered)}"


_COUNTS = f"""{_WIDE}, counts AS (
  SELECT COUNT(*) AS n, LEAST(COUNT(*), 1) AS d_,
         {', '.join(f"COUNT(DISTINCT row({', '.join(own)})) AS {_distinct(own)}" for own in _sets(3) if own)}
  FROM wide)"""
_HOLDS = f"""{_COUNTS}, holds AS (
  {' UNION ALL '.join(
      f"SELECT '{','.join(own)}' AS determinant, '{c}' AS dependent, {[','.join(p) for k in range(len(own)) for p in itertools.combinations(own, k)]}::VARCHAR[] AS parts "
      f"FROM counts WHERE {_distinct(own)} = {_distinct((*own, c))}"
      for own in _sets(2) for c in WIDE if c not in own)})"""


@query(f"""
WITH {_HOLDS}
SELECT determinant, dependent FROM holds h
WHERE NOT EXISTS (SELECT 1 FROM holds p WHERE p.dependent = h.dependent AND list_contains(h.parts, p.determinant))""")
def found_dependencies(t: Tables) -> DataFrame:
    """Minimal dependencies of the wide table, with two columns at most on the left."""
    found = D.find_dependencies(_wide(t), WIDE)
    return t.spark.createDataFrame([(",".join(own), c) for own, c in found.dependencies], "determinant string, dependent string")


@query(f"""
WITH {_COUNTS}, keys AS (
  {' UNION ALL '.join(
      f"SELECT '{','.join(own)}' AS columns, {[','.join(p) for k in range(len(own)) for p in itertools.combinations(own, k)]}::VARCHAR[] AS parts "
      f"FROM counts WHERE {_distinct(own)} = n"
      for own in _sets(2))})
SELECT columns FROM keys k WHERE NOT EXISTS (SELECT 1 FROM keys p WHERE list_contains(k.parts, p.columns))""")
def found_keys(t: Tables) -> DataFrame:
    """Minimal keys of the wide table, of two columns at most."""
    found = D.find_dependencies(_wide(t), WIDE)
    return t.spark.createDataFrame([(",".join(k),) for k in found.keys], "columns string")


@query(f"WITH {_WIDE} SELECT DISTINCT {', '.join(WIDE)} FROM wide")
def split_rejoined(t: Tables) -> DataFrame:
    """The wide table split as its dependencies propose, and joined again."""
    wide = written(_wide(t), "wide")
    found = D.find_dependencies(wide, WIDE, is_written=True)
    split = D.proposed_split(WIDE, found)
    order = D.join_order(WIDE, split, D.minimal_cover(found.dependencies))
    return D.rejoin_split(Q.split_tables(wide, split), order, WIDE)


@query("SELECT c_custkey AS row, 'c_acctbal: must not be below 0' AS error FROM customer WHERE NOT c_acctbal >= 0")
def check_constraint(t: Tables) -> DataFrame:
    return Q.error_rows(Q.judged(t.customer, [Q.not_below("c_acctbal", 0)]), "c_custkey")


@query(r"""
SELECT conv_id, turn, trim(text, E' \t\r\n') AS title,
       CASE WHEN DATE '2024-01-01' + CAST(turn AS INTEGER) >= DATE '2024-01-03' THEN DATE '2024-01-01' + CAST(turn AS INTEGER) END AS due
FROM conversations WHERE trim(text, E' \t\r\n') <> ''""")
def guard_input(t: Tables) -> DataFrame:
    as_of = dt.date(2024, 1, 3)
    entered = t.conversations.select(
        "conv_id", "turn", F.col("text").alias("title"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("turn").cast("int")).alias("due"),
    )
    return Q.guarded_titles(entered, "title").withColumn("due", P.usable_due("due", as_of))


@query("""
WITH a AS (SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1997),
     b AS (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= '1997-01-01' AND o_orderdate < '1998-01-01')
SELECT COUNT(*) AS different, COUNT(*) = 0 AS same
FROM ((SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a))""")
def same_rows(t: Tables) -> DataFrame:
    """A year filter written with year() and as a range."""
    orders = t.orders.select("o_orderkey", "o_orderdate")
    return Q.same_rows(orders.filter(F.year("o_orderdate") == 1997), orders.filter(P.in_year("o_orderdate", 1997)))


@query("SELECT l_orderkey, l_partkey, COUNT(*) - 2 AS surplus FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) <> 2")
def row_differences(t: Tables) -> DataFrame:
    """Order and part of every line against two copies of each distinct pair."""
    pairs = t.lineitem.select("l_orderkey", "l_partkey")
    once = pairs.distinct()
    return Q.row_differences(pairs, once.unionAll(once))
