"""Layouts and statistics."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.predicates import since
from millrace.functions.scalars import money_sum
from millrace.operators import layout as O
from millrace.plans.registry import USAGE, query
from millrace.scratch import new_folder, written
from millrace.sources.tables import Tables, reload_table


# Buckets or files of the tables below; a production table has as many as its tasks are to be.
BUCKETS = 16


def _clustered(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "clustered")
    O.write_clustered(t.usage(), path, "sub_id", "use_dt")
    return t.spark.read.parquet(path)


@query(f"WITH {USAGE} SELECT * FROM usage WHERE sub_id = 24 AND use_dt >= '1998-01-01'")
def clustered_read(t: Tables) -> DataFrame:
    return _clustered(t).filter((F.col("sub_id") == 24) & since("use_dt", dt.date(1998, 1, 1)))


@query(f"WITH {USAGE} SELECT use_dt, mb FROM usage WHERE sub_id = 24 AND use_dt >= '1998-01-01'")
def covered_read(t: Tables) -> DataFrame:
    return clustered_read(t).select("use_dt", "mb")


def _curved(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "curved")
    O.write_curved(t.usage(), path, ["sub_id", "use_dt"], BUCKETS)
    return t.spark.read.parquet(path)


@query(f"WITH {USAGE} SELECT * FROM usage WHERE sub_id = 24")
def curved_by_key(t: Tables) -> DataFrame:
    return _curved(t).where("sub_id = 24")


@query(f"WITH {USAGE} SELECT * FROM usage WHERE use_dt >= '1998-06-01'")
def curved_by_date(t: Tables) -> DataFrame:
    """The same files, by the other column alone."""
    return _curved(t).where(since("use_dt", dt.date(1998, 6, 1)))


@query(f"WITH {USAGE} SELECT usage_id, use_dt, strftime(use_dt, '%Y-%m') AS month FROM usage WHERE use_dt >= '1997-03-01' AND use_dt < '1997-06-01'")
def month_partitions(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "months")
    O.write_by_month(t.usage(), path, "use_dt")
    months = t.spark.read.schema("usage_id bigint, use_dt timestamp_ntz, month string").parquet(path)
    return months.filter(F.col("month").between("1997-03", "1997-05")).select("usage_id", "use_dt", "month")


@query("""
SELECT 'o_orderkey' AS "column", CAST(MIN(o_orderkey) AS VARCHAR) AS min, CAST(MAX(o_orderkey) AS VARCHAR) AS max,
       CAST(COUNT(*) - COUNT(o_orderkey) AS VARCHAR) AS num_nulls FROM orders
UNION ALL
SELECT 'o_custkey', CAST(MIN(o_custkey) AS VARCHAR), CAST(MAX(o_custkey) AS VARCHAR),
       CAST(COUNT(*) - COUNT(o_custkey) AS VARCHAR) FROM orders""")
def table_statistics(t: Tables) -> DataFrame:
    """The estimated distinct counts are left out here, as another engine estimates otherwise."""
    name = f"orders_{uuid.uuid4().hex}"
    columns = ["o_orderkey", "o_custkey"]
    stored = reload_table(t.orders.select(*columns), name, new_folder(t.spark, "orders"))
    report = O.analyze(stored, name, columns).drop("distinct_count")
    # DESCRIBE has run already, so the catalog entry is no longer needed.
    t.spark.sql(f"DROP TABLE {name}")
    return report


@query("""
SELECT o_custkey, c_name, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def bucketed_join(t: Tables) -> DataFrame:
    """Orders and customers, both dealt out by customer once: the join and the sums after it move nothing."""
    names = [f"{n}_{uuid.uuid4().hex}" for n in ("orders", "customer")]
    orders = O.write_bucketed(t.orders.select("o_custkey", "o_totalprice"), names[0], "o_custkey", BUCKETS, new_folder(t.spark, "buckets"))
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    people = O.write_bucketed(people, names[1], "o_custkey", BUCKETS, new_folder(t.spark, "buckets"))
    joined = orders.hint("merge").join(people, "o_custkey")
    out = joined.groupBy("o_custkey", "c_name").agg(F.count("*").alias("n"), money_sum("o_totalprice").cast("double").alias("total"))
    for name in names:  # the files stay, as the tables are external
        t.spark.sql(f"DROP TABLE {name}")
    return out


@query("""
SELECT o_orderkey AS usage_id, o_orderdate AS use_dt, strftime(o_orderdate, '%Y-%m') AS month FROM orders
WHERE month(o_orderdate) BETWEEN 4 AND 6 AND strftime(o_orderdate, '%Y-%m') IN (
  SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderstatus = 'F')""")
def months_of_dimension(t: Tables) -> DataFrame:
    """Months chosen by another table: only their folders are read."""
    path = new_folder(t.spark, "months")
    O.write_by_month(t.usage(), path, "use_dt")
    months = t.spark.read.schema("usage_id bigint, use_dt timestamp_ntz, month string").parquet(path)
    closed = t.orders.where("o_orderstatus = 'F'").select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()
    chosen = written(closed, "calendar").where(F.substring("month", 6, 2).between("04", "06"))
    return months.join(chosen, "month").select("usage_id", "use_dt", "month")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (7, 24, 1000000007)")
def looked_up_by_filter(t: Tables) -> DataFrame:
    """A few customers' orders by Bloom filters of the row groups."""
    path = new_folder(t.spark, "filters")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    O.write_with_filters(orders, path, ["o_custkey"])
    return t.spark.read.schema(orders.schema).parquet(path).where(F.col("o_custkey").isin(7, 24, 1000000007))
