"""Goals, streaks, heatmap and points (W6, W7, T1, T2 and T3 over tables)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import goals as G
from millrace.operators.sequences import daily_activity, month_bits, runs_of_days, streaks
from millrace.plans.registry import query
from millrace.sources.tables import Tables

AS_OF = dt.date(2024, 1, 30)


def completions(t: Tables) -> DataFrame:
    """Purchases in the role of completed goals."""
    return t.events.filter(F.col("event_type") == "purchase").select("user_id", F.to_date("ts").alias("day"))


STREAKS_SQL = """
WITH days AS (
  SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase' AND CAST(ts AS DATE) <= DATE '2024-01-30'),
back AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) - 1 AS n FROM days)
SELECT user_id, COUNT(*) FILTER (DATE '2024-01-30' - day = n) AS streak FROM back GROUP BY 1"""


@query(STREAKS_SQL)
def streak(t: Tables) -> DataFrame:
    return streaks(completions(t), "user_id", "day", AS_OF)


RUNS_SQL = """
WITH days AS (
  SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase' AND CAST(ts AS DATE) <= DATE '2024-01-30'),
runs AS (
  SELECT user_id, COUNT(*) AS n, MAX(day) AS last
  FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run FROM days) GROUP BY user_id, run)
SELECT user_id, COALESCE(MAX(n) FILTER (last = DATE '2024-01-30'), 0) AS streak, MAX(n) AS longest, CAST(SUM(n) AS BIGINT) AS days FROM runs GROUP BY 1"""


@query(RUNS_SQL)
def runs_from_months(t: Tables) -> DataFrame:
    """Streaks from a number a user and month, without the history."""
    return runs_of_days(month_bits(completions(t), "user_id", "day"), "user_id", AS_OF)


@query("""
SELECT day, COALESCE(n, 0) AS n, CAST(LEAST(COALESCE(n, 0), 3) AS INTEGER) AS level
FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-30' - 83, DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day)
LEFT JOIN (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1) USING (day)""")
def heatmap(t: Tables) -> DataFrame:
    return daily_activity(completions(t), "day", AS_OF)


def goal_events(events: DataFrame) -> DataFrame:
    """Events in the role of goal events: four goals per user, some titles blank."""
    def op(name: str) -> Column:
        return F.col("event_type") == name

    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        (F.col("user_id") * 4 + k % 4).alias("goal_id"),
        F.col("event_id").alias("seq"),
        F.when(op("signup"), "add").when(op("view"), "edit").when(op("error"), "delete").otherwise("toggle").alias("op"),
        F.when(op("view") & (F.col("value") < 10), "  ").otherwise(F.concat(F.lit(" goal "), "event_id")).alias("title"),
        F.when(k % 3 == 0, "HTML").when(k % 3 == 1, "CSS").otherwise("JS").alias("category"),
        F.date_add(F.to_date("ts"), 7).alias("due"),
        op("purchase").alias("done"),
        F.to_date("ts").alias("day"),
    )


GOALS_SQL = """
WITH log AS (
  SELECT user_id * 4 + CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 AS goal_id, event_id AS seq, event_type AS kind,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS k, value, CAST(ts AS DATE) AS day FROM events),
added AS (SELECT goal_id, MAX(seq) AS seq FROM log WHERE kind = 'signup' GROUP BY 1),
alive AS (
  SELECT a.* FROM added a WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.goal_id = a.goal_id AND l.kind = 'error' AND l.seq > a.seq)),
titles AS (
  SELECT l.goal_id, MAX(l.seq) AS seq FROM log l JOIN alive a ON l.goal_id = a.goal_id AND l.seq >= a.seq
  WHERE l.kind = 'signup' OR (l.kind = 'view' AND NOT l.value < 10) GROUP BY 1),
marks AS (
  SELECT l.goal_id, MAX(l.seq) AS seq FROM log l JOIN alive a ON l.goal_id = a.goal_id AND l.seq > a.seq
  WHERE l.kind IN ('purchase', 'click') GROUP BY 1)
SELECT alive.goal_id, 'goal ' || titles.seq AS title, CASE a.k WHEN 0 THEN 'HTML' WHEN 1 THEN 'CSS' ELSE 'JS' END AS category,
       a.day + 7 AS due, COALESCE(m.kind = 'purchase', FALSE) AS done, CASE WHEN m.kind = 'purchase' THEN m.day END AS completed
FROM alive JOIN titles USING (goal_id) JOIN log a ON a.goal_id = alive.goal_id AND a.seq = alive.seq
LEFT JOIN marks ON marks.goal_id = alive.goal_id LEFT JOIN log m ON m.goal_id = marks.goal_id AND m.seq = marks.seq"""


@query(GOALS_SQL)
def goals_folded(t: Tables) -> DataFrame:
    return G.current(G.merged(G.registers(goal_events(t.events))))


_COUNTS = "SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1"
POINTS_SQL = f"""
SELECT user_id, n, n * 10 AS xp, n * 10 // 50 + 1 AS level, CAST(round((n * 10 % 50) * 100.0 / 50) AS BIGINT) AS pct FROM ({_COUNTS})"""
LEVELS_SQL = f"SELECT user_id, unnest(range(2, n * 10 // 50 + 2)) AS level FROM ({_COUNTS}) WHERE n >= 5"


def _counts(t: Tables) -> DataFrame:
    return completions(t).groupBy("user_id").agg(F.count("*").alias("n"))


@query(POINTS_SQL)
def xp_level(t: Tables) -> DataFrame:
    return G.points(_counts(t), "user_id", "n")


@query(LEVELS_SQL)
def levels_reached(t: Tables) -> DataFrame:
    return G.levels_reached(_counts(t), "user_id", "n")


DAILY_SQL = """
SELECT CAST(ts AS DATE) AS day, user_id, COUNT(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"""


@query(DAILY_SQL)
def daily_completions(t: Tables) -> DataFrame:
    return completions(t).groupBy("day", "user_id").agg(F.count("*").alias("n"))
