"""Streams over several files against the same work on a table."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import goals as G
from millrace.operators.quality import filled_text, positive_number
from millrace.streaming import jobs, states

GOAL = "goal_id bigint, seq bigint, op string, title string, category string, due date, done boolean, day date"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
LOG = [
    (1, 1, "add", " one ", "CSS", D2, None, D1), (1, 5, "toggle", None, None, None, True, D1), (1, 6, "edit", "  ", None, None, None, D1),
    (2, 2, "add", "two", "JS", None, None, D1), (2, 7, "toggle", None, None, None, True, D1), (2, 8, "toggle", None, None, None, False, D2),
    (3, 3, "add", "three", "JS", None, None, D1), (3, 9, "toggle", None, None, None, True, D2), (3, 10, "delete", None, None, None, None, D2),
    (4, 4, "add", "four", "HTML", None, None, D1), (4, 11, "edit", "FOUR", None, None, None, D2),
    (5, 12, "add", "   ", "HTML", None, None, D2),
    (6, 13, "toggle", None, None, None, True, D2), (6, 14, "add", "six", "JS", D1, None, D2),
]
GOALS = [
    (1, "one", "CSS", D2, True, D1), (2, "two", "JS", None, False, None), (4, "FOUR", "HTML", None, False, None),
    (6, "six", "JS", D1, False, None),
]


def test_goals_in_any_order(spark):
    for log in (LOG, LOG[::-1]):
        events = spark.createDataFrame(log, GOAL).repartition(3)
        assert rows(G.current(G.merged(G.registers(events)))) == GOALS


@pytest.mark.parametrize("every", [2, 20])
def test_goal_stream(spark, tmp_path, every):
    source, state, checkpoint = (str(tmp_path / n) for n in ("in", "state", "checkpoint"))
    # The first run reads half of the log in two files, later events first; the second the rest.
    for part in (LOG[7:], LOG[4:7]):
        spark.createDataFrame(part, GOAL).coalesce(1).write.mode("append").parquet(source)
    stream = jobs.file_stream(spark, source, spark.createDataFrame([], GOAL).schema, files_per_batch=1)
    jobs.fold_goals(stream, state, checkpoint, every).awaitTermination()
    spark.createDataFrame(LOG[:4], GOAL).coalesce(1).write.mode("append").parquet(source)
    jobs.fold_goals(stream, state, checkpoint, every).awaitTermination()
    assert spark.read.parquet(f"{state}/changes").select(F.max("batch")).first()[0] == 2
    assert rows(jobs.latest_goals(spark, state)) == GOALS


@pytest.mark.parametrize("order", ["as it is", "backwards", "mixed"])
def test_goals_in_the_engine_state(spark, tmp_path, order):
    """A log out of order, with repeats and a restart in the middle, gives the goals of the whole log."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    log = {"as it is": LOG, "backwards": LOG[::-1], "mixed": LOG[1::2] + LOG[::2]}[order]
    for part in (log[:6], log[4:]):  # two rows come twice
        spark.createDataFrame(part, GOAL).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, spark.createDataFrame([], GOAL).schema)
        states.goals_in_state(stream, out, checkpoint, state_partitions=3).awaitTermination()
    assert rows(jobs.latest(spark, out, ["goal_id"]).where("alive").drop("alive")) == GOALS
    kept = {r.goal_id: r for r in states.state_of(spark, checkpoint, "goal").collect()}
    assert {g for g, r in kept.items() if r.life == "add"} == {g[0] for g in GOALS}
    assert kept[3].life == "delete" and kept[3].life_seq == 10 and kept[1].title == "one"


def test_goals_in_the_engine_state_call_no_python(spark, tmp_path):
    """A store that Python asks key by key takes milliseconds a key; null keys and settings of one number keep their rows."""
    log = [(None, 1, "add", "none", "JS", None, None, D1), (7, 2, "add", "seven", "JS", D2, None, D1), (7, 2, "add", "seven", "JS", D2, None, D1),
           (8, 3, "toggle", None, None, None, True, D1), (9, None, "add", "no number", "JS", None, None, D1)]
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    spark.createDataFrame(log, GOAL).coalesce(1).write.parquet(source)
    stream = jobs.file_stream(spark, source, spark.createDataFrame([], GOAL).schema)
    query = states.goals_in_state(stream, out, checkpoint, state_partitions=2)
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "StateStoreSave" in plan and "Python" not in plan and "TransformWithState" not in plan
    assert any(n.startswith("rocksdb") for n in query.recentProgress[0]["stateOperators"][0]["customMetrics"])
    assert rows(jobs.latest(spark, out, ["goal_id"]).where("alive").drop("alive")) == [
        (7, "seven", "JS", D2, False, None), (None, "none", "JS", None, False, None),
    ]
    assert {r.goal_id: r.life_seq for r in states.state_of(spark, checkpoint, "goal").collect()} == {None: 1, 7: 2, 8: None, 9: None}


def test_points_in_the_engine_state(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for users in ([1, 1, 2, None], [1, 3]):
        spark.createDataFrame([(u,) for u in users], "u int").coalesce(1).write.mode("append").parquet(source)
        query = states.points_in_state(jobs.file_stream(spark, source, spark.createDataFrame([], "u int").schema), "u", out, checkpoint, state_partitions=2)
        query.awaitTermination()
    assert "TransformWithState" not in query._jsq.explainInternal(False)
    expected = [(1, 3), (2, 1), (3, 1), (None, 1)]
    assert rows(states.state_of(spark, checkpoint, "points")) == expected
    assert rows(jobs.latest(spark, out, ["owner"])) == [(u, n, 10 * n) for u, n in expected]


def test_points(spark):
    counts = spark.createDataFrame([(1, 4), (2, 5), (3, 12)], "u int, n bigint")
    assert rows(G.points(counts, "u", "n")) == [(1, 4, 40, 1, 80), (2, 5, 50, 2, 0), (3, 12, 120, 3, 40)]
    assert rows(G.levels_reached(counts, "u", "n")) == [(2, 2), (3, 2), (3, 3)]


@pytest.fixture
def event_files(spark, folder, tmp_path):
    """The purchases in five files."""
    path = str(tmp_path / "events")
    events = spark.read.parquet(f"{folder}/events.parquet").filter("event_type = 'purchase'")
    events.repartitionByRange(5, "ts").write.parquet(path)
    return path, events


def test_counts_over_batches(spark, event_files, tmp_path):
    path, events = event_files
    stream = jobs.file_stream(spark, path, events.schema, files_per_batch=1)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    jobs.keep_updates(jobs.completions_by_user(stream, "user_id"), out, checkpoint, ["user_id"]).awaitTermination()
    assert spark.read.parquet(f"{out}/changes").select("batch").distinct().count() == 5
    assert rows(jobs.latest(spark, out, ["user_id"])) == rows(events.groupBy("user_id").count())


def test_snapshots_replace_what_they_cover(spark, event_files, tmp_path):
    """Twelve batches, a snapshot after every fifth; then other distances between snapshots."""
    path, events = event_files
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    events.repartition(12).write.parquet(source)
    stream = jobs.file_stream(spark, source, events.schema, files_per_batch=1)
    counts = jobs.completions_by_user(stream, "user_id")
    jobs.keep_updates(counts, out, checkpoint, ["user_id"], every=5).awaitTermination()
    assert jobs._numbers(spark, f"{out}/snapshots", "upto") == [4, 9]
    assert jobs._numbers(spark, f"{out}/changes", "batch") == list(range(5, 12))
    assert rows(jobs.latest(spark, out, ["user_id"])) == rows(events.groupBy("user_id").count())
    events.limit(50).coalesce(1).write.mode("append").parquet(source)
    jobs.keep_updates(counts, out, checkpoint, ["user_id"], every=2).awaitTermination()
    assert jobs._numbers(spark, f"{out}/snapshots", "upto") == [9, 12]
    assert rows(jobs.latest(spark, out, ["user_id"])) == rows(spark.read.parquet(source).groupBy("user_id").count())


def test_daily_windows_over_batches(spark, event_files, tmp_path):
    path, events = event_files
    # Files may come in any order, so events may be as late as the whole range.
    stream = jobs.file_stream(spark, path, events.schema, files_per_batch=1)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    daily = jobs.completions_by_day(stream, "ts", "user_id", late="60 days")
    jobs.keep_updates(daily, out, checkpoint, ["day", "user_id"]).awaitTermination()
    expected = events.groupBy(F.to_date("ts").alias("day"), "user_id").count()
    assert rows(jobs.latest(spark, out, ["day", "user_id"])) == rows(expected)


def test_events_behind_the_watermark_are_dropped(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = "ts timestamp_ntz, user_id bigint"

    def run(*stamps):
        spark.createDataFrame([(s, 1) for s in stamps], schema).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, spark.createDataFrame([], schema).schema)
        counts = jobs.completions_by_day(stream, "ts", "user_id", late="1 day")
        query = jobs.keep_updates(counts, out, checkpoint, ["day", "user_id"])
        query.awaitTermination()
        return jobs.dropped_rows(query)

    assert run(dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 10, 13), dt.datetime(2024, 1, 9, 13)) == 0
    assert run(dt.datetime(2024, 1, 9, 23), dt.datetime(2024, 1, 2, 0), dt.datetime(2024, 1, 11, 0)) == 1
    counts = {r.day.day: r.n for r in jobs.latest(spark, out, ["day", "user_id"]).collect()}
    assert counts == {9: 2, 10: 2, 11: 1}


def test_days_are_closed_once(spark, tmp_path):
    """Every row is counted once: in a final day, in an open one, or among the late rows."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = "ts timestamp_ntz, user_id bigint, note string"

    def run(*stamps):
        data = [(s, u, f"{s}") for s, u in stamps]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, spark.createDataFrame([], schema).schema)
        jobs.close_days(stream, "ts", "user_id", out, checkpoint, dt.timedelta(days=1)).awaitTermination()
        found = sorted((r.kind, r.day.day if r.day else 0, r.user_id, r.n) for r in jobs.closed_days(spark, out).collect())
        return found, sorted(r.ts.day for r in jobs.late_rows(spark, out).collect())

    def at(day, hour=0):
        return dt.datetime(2024, 1, day, hour)

    assert run((at(10, 12), 1), (at(9, 13), 1), (at(3), 2)) == ([("final", 3, 2, 1), ("open", 9, 1, 1), ("open", 10, 1, 1)], [])
    # Day 9 is open while the latest row is before the end of day 10; a row of day 3 is late, and is kept.
    assert run((at(9, 23), 1), (at(3, 5), 1), (at(10, 23), 2)) == (
        [("final", 3, 2, 1), ("open", 9, 1, 2), ("open", 10, 1, 1), ("open", 10, 2, 1)], [3]
    )
    found, late = run((at(12), 3), (at(9, 1), 2))
    assert found == [("final", 3, 2, 1), ("final", 9, 1, 2), ("final", 9, 2, 1), ("final", 10, 1, 1), ("final", 10, 2, 1), ("open", 12, 3, 1)]
    found, late = run((at(9, 2), 2), (None, 5))  # a row without a time stays open
    assert late == [3, 9] and ("open", 0, 5, 1) in found
    assert sum(n for *_, n in found) + len(late) == 10


def test_ingest(spark, tmp_path):
    source, valid, errors, checkpoint = (str(tmp_path / n) for n in ("in", "valid", "errors", "checkpoint"))
    schema = "row bigint, region string, amount string"
    rules = [filled_text("region"), positive_number("amount")]
    stream = jobs.file_stream(spark, source, spark.createDataFrame([], schema).schema)
    for part in ([(0, "a", "1"), (1, "", "x")], [(2, "b", "-1"), (3, "c", "2.5")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        jobs.ingest(stream, rules, "row", valid, errors, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(valid), "row", "batch") == [(0, 0), (3, 1)]
    assert rows(spark.read.parquet(errors), "row", "batch") == [(1, 0), (2, 1)]
