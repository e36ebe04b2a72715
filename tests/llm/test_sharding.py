"""Shards by histogram sort."""

import collections

import pytest

from millrace.llm import sharding
from llm_tables import prose

COLUMNS = "doc_id bigint, text string, size string"


def shards_of(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return by


def texts(n):
    return [(i, prose(i, 5 + i * 7 % 90), "s") for i in range(n)]


@pytest.mark.parametrize(("shards", "slice_bytes"), [(8, 1 << 24), (8, 2000), (3, 500), (1, 1000)])
def test_near_equal_bytes(spark, shards, slice_bytes):
    rows = texts(600) + [(1000 + i, "one text of many copies " * 3, "s") for i in range(400)]
    docs = spark.createDataFrame(rows, COLUMNS)
    found = sharding.sharded(docs, shards=shards, slice_bytes=slice_bytes)
    assert found.columns == ["doc_id", "text", "size", "shard", "slot"]
    got = found.collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(r[:2] for r in rows)
    by = shards_of(got)
    mean, largest = sum(r.size for r in got) / shards, max(r.size for r in got)
    assert len(by) == shards
    assert all(abs(sum(r.size for r in own) - mean) <= max(0.02 * mean, largest) for own in by.values())
    held = collections.defaultdict(set)
    for r in got:
        held[r.text].add(r.shard)
    assert all(len(s) == 1 for t, s in held.items() if not t.startswith("one text"))
    # Slices change where rows lie, not the result.
    plain = sorted((r.doc_id, r.shard, r.slot) for r in sharding.sharded(docs, shards=shards).collect())
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == plain


def test_small_groups_stay_whole(spark):
    rows = [(i, prose(i // 5, 30), "s") for i in range(2000)]
    got = sharding.sharded(spark.createDataFrame(rows, COLUMNS)).collect()
    held = collections.defaultdict(set)
    for r in got:
        held[r.text].add(r.shard)
    assert {len(s) for s in held.values()} == {1}


def test_fewer_rows_than_shards(spark):
    rows = [(1, "a", "s"), (2, None, "s"), (None, "", "s"), (2, None, "s")]
    got = sharding.sharded(spark.createDataFrame(rows, COLUMNS)).collect()
    assert sorted((r.doc_id or 0, r.size) for r in got) == [(0, 1), (1, 2), (2, 1), (2, 1)]
    assert len({r.shard for r in got if r.doc_id == 2}) == 1  # one unit
    shards_of(got)


def test_one_move(spark):
    docs = spark.createDataFrame(texts(50), COLUMNS)
    plan = sharding.sharded(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange shufflepartitionid") == 1 and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_rounds_stop_within_tolerance(spark, monkeypatch):
    rounds = []
    counted = sharding._counted
    monkeypatch.setattr(sharding, "_counted", lambda *a: rounds.append(1) or counted(*a))
    monkeypatch.setattr(sharding, "PROBES", 16)
    docs = spark.createDataFrame(texts(3000), COLUMNS)
    by = shards_of(sharding.sharded(docs, tolerance=0.05).collect())
    few, mean = len(rounds), sum(r.size for own in by.values() for r in own) / 8
    assert all(abs(sum(r.size for r in own) - mean) <= 0.1 * mean for own in by.values())
    sharding.sharded(docs).collect()
    assert few < len(rounds) - few
