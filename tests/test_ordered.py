"""Positions, running totals, order statistics and pages, with hot groups and ties."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.aggregates import lists_by, list_sizes
from millrace.operators.cleaning import encoded
from millrace.operators.order_stats import exact_quantiles, row_key_at
from millrace.operators.ordered import numbered, running
from millrace.operators.paging import by, keyset_page, offset_page, page_boundary


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows in one group, a null group, and few distinct values."""
    rng = random.Random(5)
    data = [(rng.choice(["hot"] * 5 + ["a", "b", None]), i, rng.randint(0, 9), rng.choice([0.5, 1.25, 2.0])) for i in range(4000)]
    return spark.createDataFrame(data, "g string, id long, v int, x double").repartition(8)


def brute(data, key):
    seen, out = {}, []
    for r in sorted(data, key=key):
        n, s = seen.get(r.g, (0, 0))
        seen[r.g] = (n + 1, s + r.v)
        out.append((r.id, *seen[r.g]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("descending", [False, True])
def test_running(spark, hot, descending):
    order = [F.col("v").desc() if descending else F.col("v"), F.col("id")]
    sign = -1 if descending else 1
    expected = brute(hot.collect(), lambda r: (sign * r.v, r.id))
    out = running(hot, order, {"n": F.lit(1), "s": F.col("v")}, ["g"])
    assert rows(out, "id", "n", "s") == expected
    assert rows(numbered(hot, order, ["g"], "n"), "id", "n") == [(i, n) for i, n, _ in expected]


def test_running_cuts_a_hot_group_into_slices(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(8000).withColumn("g", F.lit(1))
        out = running(df, [F.col("id")], {"n": F.lit(1)}, ["g"])
        for placed in (out, numbered(df, [F.col("id")], ["g"], "n")):
            assert placed.filter("n <> id + 1").isEmpty()
            assert placed.count() == 8000
        plan = out._jdf.queryExecution().toString()
        assert "hashpartitioning(_slice" in plan and "windowspecdefinition(_slice" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_positions_without_group_or_rows(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "id int")
    assert rows(numbered(df, [F.col("id")], name="n"), "id", "n") == [(1, 1), (2, 2), (3, 3)]
    assert numbered(df.limit(0), [F.col("id")]).count() == 0


def test_lists_in_pieces(spark, hot):
    lists = lists_by(hot, "g", F.col("v"), [F.col("id")], size=100, name="vs")
    assert lists.select(F.max(F.size("vs"))).first()[0] == 100
    expected = {}
    for r in sorted(hot.collect(), key=lambda r: r.id):
        expected.setdefault(r.g, []).append(r.v)
    got = {}
    for r in sorted(lists.collect(), key=lambda r: r.piece):
        got.setdefault(r.g, []).extend(r.vs)
    assert got == expected
    assert {r.g: r.n for r in list_sizes(lists, "g", "vs").collect()} == {g: len(v) for g, v in expected.items()}


SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("small", [1, 50, 100_000])
def test_quantiles(spark, small):
    rng = random.Random(11)
    spread = [rng.gauss(0, 100) for _ in range(3000)]
    tied = [7] * 1500 + [9] * 1400 + list(range(100))
    data = [(a, b, None if i % 5 else a) for i, (a, b) in enumerate(zip(spread, tied))]
    data += [(float("nan"), None, None)] * 3
    df = spark.createDataFrame(data, "spread double, tied int, gaps double").repartition(4)
    got = exact_quantiles(df, {c: SHARES for c in df.columns}, small=small)
    clean = df.withColumn("spread", F.expr("nullif(spread, double('NaN'))"))
    for c in df.columns:
        [expected] = clean.select(F.percentile(c, SHARES)).first()
        assert got[c] == pytest.approx(expected, rel=1e-12, abs=1e-9)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(empty, {"x": [0.5]}) == {"x": [None]}


ORDER = [("v", True), ("x", False), ("id", True)]


@pytest.mark.parametrize("index", [0, 1, 1999, 3999, 4000])
def test_row_key(spark, hot, index):
    expected = sorted(((-r.v, r.x, -r.id) for r in hot.collect()))[index:index + 1]
    got = row_key_at(hot, ORDER, index, small=20)
    assert got == ([-expected[0][0], expected[0][1], -expected[0][2]] if expected else None)


def test_pages(spark, hot):
    for offset in (0, 5, 100, 2500, 3990, 9000):
        page = offset_page(hot, ORDER, offset, 20)
        assert rows(page) == rows(hot.orderBy(*by(ORDER)).offset(offset).limit(20))
    boundary = page_boundary(hot, ORDER, 2500)
    assert rows(keyset_page(hot, ORDER, boundary, 20)) == rows(hot.orderBy(*by(ORDER)).offset(2500).limit(20))


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind", ["double", "string", "date"])
def test_pages_with_null_keys(spark, kind, descending):
    """Nulls last in either direction; NaN as the largest number; text in the order of its bytes."""
    value = {
        "double": lambda i: float("nan") if i % 10 == 3 else float(i % 37),
        "string": lambda i: ("é", "z", "Z", "")[i % 4] + str(i % 29),
        "date": lambda i: dt.date(2020, 1, 1 + i % 28),
    }[kind]
    df = spark.createDataFrame([(None if i % 7 == 0 else value(i), i) for i in range(700)], f"k {kind}, id int")
    order = [("k", descending), ("id", False)]
    want = [r.id for r in df.orderBy(*by(order)).collect()]
    for offset in (0, 5, 99, 410, 590, 605, 690, 700):
        assert [r.id for r in offset_page(df, order, offset, 20).collect()] == want[offset : offset + 20]
    for index in (0, 250, 599, 650):
        assert row_key_at(df, order, index, small=5)[-1] == want[index]
    assert row_key_at(df, order, 700, small=5) is None


def test_sort_order(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 4), (4, None), (5, 5)], "id int, v int")
    assert [r.id for r in df.orderBy(*by([("v", False), ("id", False)])).collect()] == [3, 2, 5, 1, 4]
    assert [r.id for r in df.orderBy(*by([("v", True), ("id", True)])).collect()] == [5, 2, 3, 4, 1]


def test_row_key_of_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 30)], "day date")
    assert row_key_at(df, [("day", True)], 3, small=1) == [dt.date(2024, 1, 26)]


def test_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "x string")
    assert rows(encoded(df, "x"), "x", "code") == [("a", 0), ("b", 1), ("b", 1), ("c", 2), (None, -1)]


@pytest.mark.parametrize("same", [0, 70, 300])
def test_text_keys_with_long_beginnings(spark, same):
    """Most texts share their first characters, a few come before and after; only short parts of them are sampled."""
    texts = ["a", "zz", "z"] + ["m" * same + f"{i % 700:04d}" + "t" * (i % 3) for i in range(3000)] + ["m" * same] * 40
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "name string, id int").repartition(4)
    ordered = sorted((t, i) for i, t in enumerate(texts))
    for index in (0, 1, 700, 2222, len(texts) - 1):
        assert tuple(row_key_at(df, [("name", False), ("id", False)], index, small=10)) == ordered[index]
