"""Goals and points as state of the engine, in RocksDB, and a reader of that state.

A key's state is what its events have set so far, each field with the sequence number that set it, so events may arrive
in any order and be repeated. The engine's own aggregates keep it: a state operator in Python asks the store for one key
at a time, which takes milliseconds for each. A restarted query goes on from its checkpoint. Output is every goal that a
batch has events of.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.scalars import XP_PER_GOAL
from millrace.operators.goals import registers
from millrace.streaming.jobs import STATE_PARTITIONS, completions_by_user, keep_updates

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that are started within keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


# The fields that are set together, each group after the sequence number that it goes by.
SETTINGS = {
    "life": ["life_seq", "life"],
    "title": ["title_seq", "title"],
    "added": ["add_seq", "added.category", "added.due"],
    "mark": ["done_seq", "mark.done", "mark.completed"],
}
# Key and aggregates of each state, in the order in which the store has them.
STATES = {"goal": ["goal_id", *SETTINGS], "points": ["owner", "n"]}


def _latest_settings(events: DataFrame) -> DataFrame:
    """The greatest sequence number of every field of a goal, and what it set."""
    return registers(events).groupBy("goal_id").agg(
        *[F.max(F.when(F.col(seq).isNotNull(), F.struct(seq, *fields))).alias(name) for name, (seq, *fields) in SETTINGS.items()]
    )


def goals_in_state(
    events: DataFrame, path: str, checkpoint: str, every: int | None = None, state_partitions: int = STATE_PARTITIONS
) -> StreamingQuery:
    """Write the goals that each batch has events of; rows (goal_id, alive, title, category, due, done, completed)."""
    alive = F.coalesce(F.col("life.life") == "add", F.lit(False)).alias("alive")
    changed = _latest_settings(events).select(
        "goal_id", alive, "title.title", "added.category", "added.due", "mark.done", "mark.completed"
    )
    with rocksdb(events.sparkSession):
        return keep_updates(changed, path, checkpoint, ["goal_id"], every, state_partitions)


def points_in_state(
    done: DataFrame, user: str, path: str, checkpoint: str, every: int | None = None, state_partitions: int = STATE_PARTITIONS
) -> StreamingQuery:
    """Write the points of users with new completions; rows (owner, n, xp)."""
    counts = completions_by_user(done.select(F.col(user).cast("bigint").alias("owner")), "owner")
    changed = counts.withColumn("xp", F.col("n") * XP_PER_GOAL)
    with rocksdb(done.sparkSession):
        return keep_updates(changed, path, checkpoint, ["owner"], every, state_partitions)


def state_of(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """Rows of the state of a stopped query: `goal` (goal_id, the sequence numbers and what they set) or `points` (owner, n)."""
    read = spark.read.format("statestore").option("path", checkpoint).load()
    key, *names = STATES[variable]
    # The aggregates' columns in the store share a name, so they are renamed by their places.
    named = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, read.schema["value"].dataType, strict=True)])
    kept = read.select(F.col("key")[key].alias(key), F.col("value").cast(named).alias("value")).select(key, "value.*")
    return kept.select(*[f"{f.name}.*" if isinstance(f.dataType, T.StructType) else f.name for f in kept.schema])
