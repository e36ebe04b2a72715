"""Every query against its SQL on the same tables."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry_points
from millrace.operators.layout import plan_features
from millrace.plans import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def text(value):
    if isinstance(value, float):
        return value.hex()
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return f"{type(value).__name__} {value}"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, folder, name):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted(tuple(text(r[c]) for c in columns) for r in df.collect())

    result = duck.execute(SQL[name])
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    order = [list(types).index(c) for c in columns]
    expected = sorted(tuple(text(r[i]) for i in order) for r in result.fetchall())

    assert {f.name: f.dataType.simpleString() for f in df.schema} == types
    assert len(got) == len(expected)
    assert got == expected
    joins = plan_features(df)["joins"]
    assert "Cartesian" not in joins and "NestedLoop" not in joins


def test_queries_without_sql():
    assert set(QUERIES) == set(SQL)


SORTED = {
    "sorted_rows": [("segment", False), ("c_acctbal", True), ("c_custkey", False)],
    "due_order": [("due", False), ("event_id", False)],
    "newest_first": [("event_id", True)],
    "active_join": [("p_retailprice", True), ("s_name", False), ("p_name", False)],
    "offset_page": [("use_dt", True), ("usage_id", True)],
    "page_null_keys": [("balance", True), ("c_custkey", False)],
    "page_text_key": [("p_name", False), ("p_partkey", False)],
}


@pytest.mark.parametrize("name", sorted(SORTED))
def test_order_of_rows(spark, folder, name):
    def key(row):
        out = []
        for column, descending in SORTED[name]:
            v = row[column]
            v = v.toordinal() if isinstance(v, dt.date) else v
            v = v.encode() if isinstance(v, str) else v
            out.append((v is None, 0 if v is None else -v if descending else v))
        return out

    got = [key(r) for r in QUERIES[name](spark, folder).collect()]
    assert got == sorted(got) and got


def test_entry_points(spark):
    assert entry_points.entry(spark).columns == ["region", "total", "avg", "cnt"]
    assert entry_points.entry(spark).count() == 5
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
