"""Current goals and points from a log of goal events.

Events: goal_id, seq, op (add, edit, toggle, delete), title, category, due, done, day. Every
field of a goal is set by the latest event that may set it, so each is kept with the sequence
number that set it. Two such rows of a goal merge into one, in any order, which serves events
in a table, events that arrive late, and a stored state alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.predicates import usable_title
from millrace.functions.scalars import XP_PER_GOAL, level_of, level_percent, trimmed


def registers(events: DataFrame) -> DataFrame:
    """One row per event: what it sets, with its sequence number."""
    op, seq = F.col("op"), F.col("seq")
    titled = usable_title("title")
    adds = (op == "add") & titled

    def setting(condition: Column) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), seq)

    return events.select(
        "goal_id",
        setting(adds | (op == "delete")).alias("life_seq"),
        op.alias("life"),
        setting(op.isin("add", "edit") & titled).alias("title_seq"),
        trimmed("title").alias("title"),
        setting(adds).alias("add_seq"),
        F.struct("category", "due").alias("added"),
        # A new goal is open, so adding sets the done mark as well.
        setting(adds | (op == "toggle")).alias("done_seq"),
        F.struct(
            ((op == "toggle") & F.col("done")).alias("done"),
            F.when((op == "toggle") & F.col("done"), F.col("day")).alias("completed"),
        ).alias("mark"),
    )


FIELDS = [("life", "life_seq"), ("title", "title_seq"), ("added", "add_seq"), ("mark", "done_seq")]


def merged(rows: DataFrame) -> DataFrame:
    """The latest setting of every field, per goal."""
    return rows.groupBy("goal_id").agg(
        *[c for value, seq in FIELDS for c in (F.max_by(value, seq).alias(value), F.max(seq).alias(seq))]
    )


def current(state: DataFrame) -> DataFrame:
    """Goals that exist now."""
    return state.filter(F.col("life") == "add").select(
        "goal_id",
        "title",
        "added.category",
        "added.due",
        "mark.done",
        "mark.completed",
    )


def points(completions: DataFrame, user: str, n: str) -> DataFrame:
    """Points, level and percent of the level from the number of completions."""
    xp = (F.col(n) * XP_PER_GOAL).cast("long")
    return completions.select(user, n, xp.alias("xp")).withColumns(
        {"level": level_of("xp"), "pct": level_percent("xp")}
    )


def levels_reached(completions: DataFrame, user: str, n: str) -> DataFrame:
    """One row per user and level above the first."""
    level = level_of(F.col(n) * XP_PER_GOAL)
    return completions.withColumn("_level", level).filter("_level > 1").select(
        user, F.explode(F.sequence(F.lit(2).cast("long"), F.col("_level"))).alias("level")
    )
