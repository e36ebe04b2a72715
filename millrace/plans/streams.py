"""Streaming jobs over the events and customers (T1-T4), each run until its input is read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import goals as G
from millrace.operators.quality import not_below, positive_number
from millrace.operators.sequences import runs_of_days
from millrace.plans.activity import AS_OF, DAILY_SQL, GOALS_SQL, LEVELS_SQL, POINTS_SQL, RUNS_SQL, goal_events
from millrace.plans.registry import query
from millrace.scratch import new_folder
from millrace.sources.tables import Tables
from millrace.streaming import jobs, states


def _stream(t: Tables, name: str) -> DataFrame:
    return jobs.file_stream(t.spark, t.path(name), getattr(t, name).schema)


def _purchases(t: Tables) -> DataFrame:
    return _stream(t, "events").filter(F.col("event_type") == "purchase")


@query(DAILY_SQL)
def daily_completions_streamed(t: Tables) -> DataFrame:
    out = new_folder(t.spark, "daily")
    # The whole past is read, in files of any order, so nothing may count as late.
    counts = jobs.completions_by_day(_purchases(t), "ts", "user_id", late="36500 days")
    stream = jobs.keep_updates(counts, f"{out}/rows", f"{out}/checkpoint", ["day", "user_id"])
    stream.awaitTermination()
    if jobs.dropped_rows(stream):
        raise ValueError("the stream dropped late rows")
    return jobs.latest(t.spark, f"{out}/rows", ["day", "user_id"])


@query(GOALS_SQL)
def goals_in_state(t: Tables) -> DataFrame:
    """The goals as state that the engine keeps, from a log in two deliveries with a restart between."""
    out = new_folder(t.spark, "goal-state")
    events = t.events
    for part in (1, 0):  # the later half of the ids first
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{out}/in")
        stream = jobs.file_stream(t.spark, f"{out}/in", events.schema)
        states.goals_in_state(goal_events(stream), f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return jobs.latest(t.spark, f"{out}/rows", ["goal_id"]).where("alive").drop("alive")


@query(POINTS_SQL)
def points_in_state(t: Tables) -> DataFrame:
    """Points from the state itself, as the stream has left it."""
    out = new_folder(t.spark, "point-state")
    states.points_in_state(_purchases(t), "user_id", f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    kept = states.state_of(t.spark, f"{out}/checkpoint", "points").withColumnRenamed("owner", "user_id")
    return G.points(kept, "user_id", "n")


_PARTS = """parts AS (
  SELECT CAST(ts AS DATE) AS day, user_id, ts, event_id % 3 AS b FROM events WHERE event_type = 'purchase'),
marks AS (
  SELECT (SELECT MAX(ts) FROM parts WHERE b = 0) - INTERVAL 2 DAY AS w1, (SELECT MAX(ts) FROM parts WHERE b < 2) - INTERVAL 2 DAY AS w2,
         (SELECT MAX(ts) FROM parts) - INTERVAL 2 DAY AS w3),
kinds AS (
  SELECT day, user_id, CASE WHEN b = 1 AND day + 1 <= w1 OR b = 2 AND day + 1 <= w2 THEN 'late'
                            WHEN day + 1 <= w3 THEN 'final' ELSE 'open' END AS kind
  FROM parts, marks)"""


@query(f"WITH {_PARTS} SELECT kind, day, user_id, COUNT(*) AS n FROM kinds GROUP BY ALL")
def daily_closed_streamed(t: Tables) -> DataFrame:
    """Three deliveries of the purchases; a day is final two days after it ended, and rows that come later are kept apart."""
    out = new_folder(t.spark, "closed")
    purchases = t.events.filter(F.col("event_type") == "purchase")
    for part in range(3):
        purchases.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{out}/in")
        stream = jobs.file_stream(t.spark, f"{out}/in", purchases.schema)
        jobs.close_days(stream, "ts", "user_id", f"{out}/days", f"{out}/checkpoint", dt.timedelta(days=2)).awaitTermination()
    late = jobs.late_rows(t.spark, f"{out}/days").groupBy(F.to_date("ts").alias("day"), "user_id").agg(F.count("*").alias("n"))
    return jobs.closed_days(t.spark, f"{out}/days").unionByName(late.withColumn("kind", F.lit("late"))).select("kind", "day", "user_id", "n")


def _streamed_counts(t: Tables) -> DataFrame:
    out = new_folder(t.spark, "points")
    counts = jobs.completions_by_user(_purchases(t), "user_id")
    jobs.keep_updates(counts, f"{out}/rows", f"{out}/checkpoint", ["user_id"]).awaitTermination()
    return jobs.latest(t.spark, f"{out}/rows", ["user_id"])


@query(POINTS_SQL)
def xp_streamed(t: Tables) -> DataFrame:
    return G.points(_streamed_counts(t), "user_id", "n")


@query(LEVELS_SQL)
def levels_streamed(t: Tables) -> DataFrame:
    return G.levels_reached(_streamed_counts(t), "user_id", "n")


@query(GOALS_SQL)
def goals_streamed(t: Tables) -> DataFrame:
    out = new_folder(t.spark, "goals")
    jobs.fold_goals(goal_events(_stream(t, "events")), f"{out}/state", f"{out}/checkpoint").awaitTermination()
    return jobs.latest_goals(t.spark, f"{out}/state")



@query(RUNS_SQL)
def runs_streamed(t: Tables) -> DataFrame:
    out = new_folder(t.spark, "months")
    done = _purchases(t).select("user_id", F.to_date("ts").alias("day"))
    jobs.fold_months(done, "user_id", "day", f"{out}/state", f"{out}/checkpoint").awaitTermination()
    return runs_of_days(jobs.latest_months(t.spark, f"{out}/state", "user_id"), "user_id", AS_OF)


def _ingested(t: Tables) -> tuple[DataFrame, DataFrame]:
    out = new_folder(t.spark, "ingest")
    rules = [positive_number("c_acctbal"), not_below("c_nationkey", 5)]
    jobs.ingest(
        _stream(t, "customer"), rules, "c_custkey", f"{out}/valid", f"{out}/errors", f"{out}/checkpoint"
    ).awaitTermination()
    return t.spark.read.parquet(f"{out}/valid"), t.spark.read.parquet(f"{out}/errors")


@query("SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_nationkey >= 5")
def ingest_valid(t: Tables) -> DataFrame:
    return _ingested(t)[0].select("c_custkey", "c_nationkey", "c_acctbal")


@query("""
SELECT c_custkey AS row, concat_ws('; ', CASE WHEN NOT c_acctbal > 0 THEN 'c_acctbal: must be a number greater than 0' END,
       CASE WHEN NOT c_nationkey >= 5 THEN 'c_nationkey: must not be below 5' END) AS error
FROM customer WHERE NOT (c_acctbal > 0 AND c_nationkey >= 5)""")
def ingest_errors(t: Tables) -> DataFrame:
    return _ingested(t)[1].select("row", "error")
