"""Settings and the folder for intermediate tables."""

import os

import pytest

from millrace import scratch
from millrace.session import SHUFFLE_PARTITIONS, at_most_partitions, path_bytes, prepare, size_shuffles, wanted_partitions
from millrace.sources.tables import Tables


def test_shuffle_partitions_follow_the_input(spark, folder):
    assert wanted_partitions(4 * 2**20) == 1
    assert wanted_partitions(2**40) == 6144
    assert wanted_partitions(100 * 2**40) == 614_400
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    size_shuffles(spark, 100 * 2**40)
    assert spark.conf.get(SHUFFLE_PARTITIONS) == "614400"
    assert path_bytes(spark, f"{folder}/orders.parquet") > 0 == path_bytes(spark, f"{folder}/none.parquet")
    Tables(spark, folder).orders  # the next query starts from what the session had
    assert spark.conf.get(SHUFFLE_PARTITIONS) == before
    with at_most_partitions(spark, 2):
        assert spark.conf.get(SHUFFLE_PARTITIONS) == "2"
    assert spark.conf.get(SHUFFLE_PARTITIONS) == before


class Cluster:
    """As much of a session as the scratch folder looks at."""

    def __init__(self, folder, master="yarn"):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_scratch_folder():
    assert scratch.scratch_root(Cluster("hdfs://shared/check/")) == "hdfs://shared/check"
    assert scratch.new_folder(Cluster("/shared"), "a") != scratch.new_folder(Cluster("/shared"), "a")
    assert scratch.scratch_root(Cluster(None, "local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Cluster(None))


def test_written_table_cuts_the_lineage(spark):
    df = scratch.written(spark.range(10).selectExpr("id", "id % 3 AS k"), "test")
    assert df.count() == 10 and df.columns == ["id", "k"]
    assert "Range (" not in df._jdf.queryExecution().toString()


def test_clear(spark):
    before = scratch.written(spark.range(3), "test")
    [path] = [p for p in scratch._made if p in before.inputFiles()[0]]
    scratch.clear(spark)
    assert not os.path.exists(path) and scratch._made == []


def test_hash_tables_of_large_tables_are_small(spark, folder, monkeypatch):
    """At 6 GB a task gets 10 MB of a table's files, and merged partitions stay small; operators on texts keep theirs."""
    monkeypatch.setattr("millrace.sources.tables.path_bytes", lambda *_: 6 * 2**30)
    try:
        Tables(spark, folder).lineitem
        assert int(spark.conf.get(SHUFFLE_PARTITIONS)) == 600
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    finally:
        size_shuffles(prepare(spark), 0)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "64m"
