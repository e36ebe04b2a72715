"""Small tables with known results."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions import predicates as P
from millrace.functions import scalars as S
from millrace.operators import aggregates as A
from millrace.operators import cleaning as C
from millrace.operators import joins as J
from millrace.operators import quality as Q
from millrace.operators.sequences import before_marker, daily_activity, merged_bits, month_bits, runs_of_days, streaks

DIRTY = [
    ("2023-03-01", "north", 10, "tea"), ("2023-03-02", "south", 20, "tea"), ("2023-03-03", "east", None, "cocoa"),
    ("2023-03-04", "north", 30, None), (None, "west", 40, "cocoa"), ("2023-03-06", "east", 50, "tea"),
    ("2023-03-07", "south", 60, "cocoa"), ("2023-03-08", "west", 70, "tea"), ("2023-03-09", "north", 9000, "tea"),
]
TIERS = [("north", "gold"), ("south", "silver"), ("east", "silver"), ("west", "bronze")]
NAMES = {"tea": "Tee", "cocoa": "Kakao"}


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(DIRTY, "date string, region string, amount bigint, category string").withColumn(
        "amount", F.col("amount").cast("double")
    )


def test_null_report(dirty):
    report = {r.column: (r.nulls, r.pct) for r in A.null_report(dirty, dirty.columns).collect()}
    one = (1, pytest.approx(100 / 9))
    assert report == {"date": one, "region": (0, 0.0), "amount": one, "category": one}


def test_missing_numbers(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "x double")
    assert A.null_report(df, ["x"]).first().nulls == 2
    assert df.select(S.average("x")).first()[0] == 2.0
    [found] = A.describe_numeric(df, ["x"]).collect()
    assert (found.cnt, found["mean"], found["min"], found.median, found["max"]) == (2, 2.0, 1.0, 2.0, 3.0)


def test_median_mode_and_outliers(dirty):
    filled = C.fill_with_mode(C.fill_with_median(dirty, "amount"), "category")
    assert filled.filter("date = '2023-03-03'").first().amount == 45.0
    assert filled.filter("date = '2023-03-04'").first().category == "tea"
    assert A.mode_of(dirty, "category").first().n == 5
    dated = filled.na.drop(subset=["date", "amount"])
    assert dated.count() == 8
    assert C.iqr_bounds(dated, "amount") == {"q1": 27.5, "q3": 62.5, "low": -25.0, "high": 115.0}
    assert rows(C.iqr_outliers(dated, "amount"), "date", "region", "amount") == [("2023-03-09", "north", 9000.0)]
    assert C.iqr_kept(dated, "amount").count() == 7


def test_cleaning_in_order(dirty):
    out = C.cleaned_sales(dirty, NAMES)
    assert out.count() == 7
    first = out.filter("date = DATE '2023-03-01'").first()
    assert (first.category_upper, first.year, first.month, first.weekday) == ("TEE", 2023, 3, "Wednesday")


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "x string")
    assert rows(A.mode_of(df, "x")) == [("a", 2)]
    [described] = A.describe_text(df, ["x"]).collect()
    assert (described.cnt, described.uniq, described.top, described.freq) == (4, 2, "a", 2)


def test_totals_by_region(dirty):
    got = {r.region: (r.total, round(r.avg, 2), r.cnt) for r in A.totals_by(dirty.filter("amount > 0"), ["region"], "amount").collect()}
    assert got == {"north": (9040.0, 3013.33, 3), "south": (80.0, 40.0, 2), "east": (50.0, 50.0, 1), "west": (110.0, 55.0, 2)}


def test_means_leave_nulls_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 4.0)], "k string, x double")
    assert rows(A.totals_by(df, ["k"], "x")) == [("a", 1.0, 1.0, 2), ("b", None, None, 1), (None, 4.0, 4.0, 1)]


def test_tier_join(spark, dirty):
    tiers = spark.createDataFrame(TIERS + [(None, "x")], "region string, tier string")
    joined = J.with_small(dirty, tiers, "region").orderBy(F.desc_nulls_last("amount"), "region")
    first = [(r.region, r.amount, r.tier) for r in joined.limit(3).collect()]
    assert first == [("north", 9000.0, "gold"), ("west", 70.0, "bronze"), ("south", 60.0, "silver")]
    assert joined.count() == 9


def test_lookup(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert rows(J.looked_up(df, "k", {"a": "A"}, "v")) == [("a", "A"), ("z", None), (None, None)]
    wide = {f"k{i}": f"v{i}" for i in range(500)} | {"a": "A", None: "B"}
    assert rows(J.looked_up(df, "k", wide, "v")) == [("a", "A"), ("z", None), (None, None)]


def test_rollup_labels_only_the_total(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "one", 10.0), (2, "two", None), (3, "three", 30.0)], "id int, name string, fee double")
    out = A.rollup_totals(facts, "k", dim, "id", "name", "fee", "전체", 2)
    assert rows(out) == [("1", "one", 2, 10.0), ("2", "two", 2, None), ("전체", "전체", 5, 17.0)]


def test_remaining_and_progress(spark):
    df = spark.createDataFrame([("CSS", False), ("CSS", None), ("JS", True), ("Go", False)], "c string, d boolean")
    assert rows(A.remaining_by(df, "c", F.col("d"), ["HTML", "CSS", "JS"])) == [(0, "HTML", 0), (1, "CSS", 2), (2, "JS", 0)]
    assert rows(A.progress(df, F.col("d"))) == [(4, 1, 25)]
    assert rows(A.progress(df.limit(0), F.col("d"))) == [(0, 0, 0)]


def test_squares_do_not_overflow(spark):
    n = 5_000_000
    total = A.sum_of_squares(spark.range(n), "id", F.col("id") % 8).agg(F.sum("squares")).first()[0]
    assert int(total) == 41666654166667500000


def test_normal_forms(spark):
    day = dt.date(2023, 5, 4)
    wide = spark.createDataFrame(
        [(1, 1, day, 7, "Ann", "p", "pen", 2.0), (1, 2, day, 7, "Ann", "i", "ink", 5.0), (2, 1, day, 8, "Bo", "p", "pen", 2.0)],
        "number int, line int, day date, buyer int, name string, part string, label string, price double",
    )
    n = Q.split_tables(wide, {
        "lines": ["number", "line", "part"], "orders": ["number", "day", "buyer"],
        "buyers": ["buyer", "name"], "parts": ["part", "label", "price"],
    })
    assert {k: v.count() for k, v in n.items()} == {"lines": 3, "orders": 2, "buyers": 2, "parts": 2}
    back = Q.rejoined(n["lines"], [(n["orders"], "number"), (n["buyers"], "buyer"), (n["parts"], "part")], wide.columns)
    assert Q.same_rows(wide, back).first().same
    assert not Q.same_rows(wide, back.unionAll(back.limit(1))).first().same
    assert Q.key_violations(wide, ["number", "part"]).isEmpty()
    assert rows(Q.dependency_violations(wide, ["number"], ["part"])) == [(1, 2)]
    assert Q.dependency_violations(wide, ["part"], ["label", "price"]).isEmpty()


def test_differences_count_as_often_as_a_row_is_in_surplus(spark):
    left = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, None), (3, "c"), (3, "c")], "k int, v string")
    sql = "SELECT COUNT(*) FROM ((SELECT * FROM l EXCEPT ALL SELECT * FROM r) UNION ALL (SELECT * FROM r EXCEPT ALL SELECT * FROM l))"
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    assert rows(Q.same_rows(left, right)) == [(spark.sql(sql).first()[0], False)] == [(5, False)]
    assert rows(Q.same_rows(left, left)) == rows(Q.same_rows(left.limit(0), left.limit(0))) == [(0, True)]


def test_rejoined_differences_are_those_of_the_join(spark):
    """Null keys and parents, keys without a parent or with two, a row that occurs twice, and rows of one side only."""
    items = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 9), (5, None), (6, 3)], "line int, k int")
    parent = spark.createDataFrame([(1, "one"), (2, None), (3, "three"), (3, "drei"), (None, "none"), (8, "eight")], "k int, name string")
    wide = spark.createDataFrame(
        [("one", 1, 1), ("one", 1, 1), ("ONE", 2, 1), (None, 3, 2), (None, 5, None), ("three", 6, 3), ("x", 7, 8)], "name string, line int, k int"
    )
    back = Q.rejoined(items, [(parent, "k")], wide.columns)
    found = rows(Q.rejoined_differences(wide, items, parent, "k"))
    assert found == rows(Q.row_differences(wide, back)) and len(found) == 6
    assert rows(Q.rejoined_differences(back, items, parent, "k")) == []
    assert rows(Q.rejoined_differences(wide.limit(0), items, parent, "k")) == rows(Q.row_differences(wide.limit(0), back))


def test_keys_and_orphans(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (3, None), (4, 9), (4, 9)], "k int, p int")
    assert rows(Q.key_violations(df, ["k"])) == [(1, 2), (4, 2), (None, 1)]
    parents = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    assert rows(Q.orphans(df, "p", parents, "id")) == [(9, 2)]
    assert rows(Q.null_counts(df, ["k", "p"])) == [("k", 1), ("p", 1)]


def test_outer_joins(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id int")
    children = spark.createDataFrame([(1, 5.0, "A"), (1, 7.0, "A"), (2, 1.0, "X"), (None, 9.0, "A")], "pid int, v double, s string")
    assert rows(J.without_match(parents, "id", children, "pid")) == [(3,), (None,)]
    assert rows(J.without_match(parents, "id", children, "pid", F.col("s") == "A")) == [(2,), (3,), (None,)]
    assert rows(J.with_match(parents, "id", children, "pid")) == [(1,), (2,)]
    assert rows(J.with_total(parents, "id", children, "pid", "v")) == [(1, 12.0), (2, 1.0), (3, None), (None, None)]


def test_ages(spark):
    births = [dt.date(2000, 2, 29), dt.date(2000, 3, 1), dt.date(1973, 2, 28), None]
    df = spark.createDataFrame([(b,) for b in births], "b date")
    out = df.withColumn("age", S.whole_years("b", F.lit(dt.date(2023, 2, 28)))).withColumn("grp", S.age_group("age"))
    assert [(r.age, r.grp) for r in out.collect()] == [(22, "청년"), (22, "청년"), (50, "장년"), (None, "장년")]
    assert df.limit(1).select(S.whole_years("b", F.lit(dt.date(2023, 3, 1)))).first()[0] == 23


def test_text_functions(spark):
    df = spark.createDataFrame([(" \t<a href=\"x\">& </a>\r\nnext\n",)], "x string")
    trimmed = S.trimmed("x")
    assert df.select(trimmed).first()[0] == '<a href="x">& </a>\r\nnext'
    assert df.select(S.html_escaped(S.first_line(trimmed))).first()[0] == '&lt;a href="x"&gt;&amp;&nbsp;&lt;/a&gt;'


def test_number_functions(spark):
    df = spark.createDataFrame([(1234567, 0, 1), (-1500, 45, 2), (0, 50, 7)], "n bigint, xp bigint, c int")
    got = df.select(S.with_thousands("n"), F.round("n", -3), S.level_of("xp"), S.level_percent("xp"), S.activity_level("c"))
    assert [tuple(r) for r in got.collect()] == [("1,234,567", 1235000, 1, 0, 1), ("-1,500", -2000, 1, 90, 2), ("0", 0, 2, 0, 3)]


def test_character_classes(spark):
    texts = {"aA1!": True, "aA٣!": True, "aA1": False, "a1!": False, "A1!": False, "aA!": False, "aA1!\n": True, "a\nA1!": False, "": False}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.ok for r in df.select("t", P.has_all_classes("t").alias("ok")).collect()} == texts


def test_range_tests_with_nulls(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    assert rows(df.filter(P.outside("x", 2, 9))) == [(1,), (None,)]
    assert rows(df.filter(F.col("x").between(5, 9))) == [(5,)]


def test_goal_filters(spark):
    today = dt.date(2024, 5, 5)
    data = [(1, "learn CSS", None, None), (2, "learn JS", dt.date(2024, 5, 4), False), (3, "css", dt.date(2024, 5, 4), True), (4, "JS", today, False)]
    df = spark.createDataFrame(data, "id int, title string, due date, done boolean")
    assert rows(df.filter(P.overdue("due", "done", today)), "id") == [(2,)]
    assert rows(df.filter(P.title_contains("title", " CSS ")), "id") == [(1,)]
    assert df.filter(P.title_contains("title", "  ")).count() == 4
    assert rows(df.filter(P.in_tab("done", "active")), "id") == [(1,), (2,), (4,)]
    assert rows(df.filter(P.in_tab("done", "done")), "id") == [(3,)]
    assert df.filter(P.in_tab("done", "all")).count() == 4
    assert rows(df.select("id", P.usable_due("due", today))) == [(1, None), (2, None), (3, None), (4, today)]


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024-02-29",), (None,)], "t string")
    assert rows(df.select(S.lenient_date("t"))) == [(None,), (None,), (dt.date(2024, 2, 29),)]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        df.select(S.strict_date("t")).collect()


def test_marker(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "!quit"), ("a", 3, "x"), ("b", 1, "x"), ("c", 1, "!quit"), (None, 1, "x")], "g string, n int, t string")
    assert rows(before_marker(df, "g", "n", F.col("t") == "!quit"), "g", "n") == [("a", 1), ("b", 1), (None, 1)]


def test_streaks_and_days(spark):
    today = dt.date(2024, 1, 10)
    days = {1: [10, 9, 9, 8, 6], 2: [9, 8], 3: [10], 4: [11, 10, 9]}
    data = [(u, dt.date(2024, 1, d)) for u, ds in days.items() for d in ds]
    df = spark.createDataFrame(data, "u int, d date")
    assert rows(streaks(df, "u", "d", today)) == [(1, 3), (2, 0), (3, 1), (4, 2)]
    dense = daily_activity(df, "d", today)
    assert dense.count() == 84
    levels = {r.day.day: (r.n, r.level) for r in dense.filter("n > 0").collect()}
    assert levels == {6: (1, 1), 8: (2, 2), 9: (4, 3), 10: (3, 3)}


def test_money_sums_are_exact(spark):
    rng = random.Random(2)
    cents = [rng.randint(-10**15, 10**15) for _ in range(3000)] + [0, 1, -1]
    df = spark.createDataFrame([(c / 100,) for c in cents] + [(None,), (float("nan"),)], "x double").repartition(7)
    assert df.select(S.money_sum("x")).first()[0] == Decimal(sum(cents)) / 100
    assert df.filter("x IS NULL").select(S.money_sum("x"), S.average("x")).first() == (None, None)
    tenths = spark.range(10).select(F.lit(0.1).alias("x"))
    assert tenths.select(S.money_sum("x").cast("double")).first()[0] == 1.0


def test_trimmed_white_space(spark):
    df = spark.createDataFrame([("\u3000a b\u00a0",), ("\x0b\x0c",), ("\ufeff c\u2003",)], "t string")
    assert [r[0] for r in df.select(S.trimmed("t")).collect()] == ["a b", "", "c"]
    assert Q.guarded_titles(df, "t").count() == 2


def test_places_of_sums(spark):
    df = spark.createDataFrame([(0.004,)] * 3, "x double")
    assert df.select(S.money_sum("x", 3)).first()[0] == Decimal("0.012")
    with pytest.raises(Exception, match="more than 2 places"):
        df.select(S.money_sum("x")).collect()


def test_runs_merge_from_any_parts(spark):
    """However a history is split, repeated and ordered, its months give the same runs as its days."""
    rng = random.Random(6)
    first = dt.date(2023, 11, 20)
    history = {u: sorted({first + dt.timedelta(days=rng.randrange(80)) for _ in range(rng.choice([1, 30, 200]))}) for u in range(12)}
    data = [(u, d) for u, days in history.items() for d in days] + [(None, first), (1, None)]
    rng.shuffle(data)
    make = lambda part: spark.createDataFrame(part, "u int, day date")
    parts = [month_bits(make(p), "u", "day") for p in (data[:40], data[30:200], data[150:])]
    merged = merged_bits(parts[2].union(parts[0]).union(parts[1]), "u")
    assert rows(merged) == rows(month_bits(make(data), "u", "day"))
    as_of = dt.date(2024, 1, 31)
    found = {r.u: (r.streak, r.longest, r.days) for r in runs_of_days(merged, "u", as_of).collect()}
    plain = {r.u: r.streak for r in streaks(make([r for r in data if r[1]]), "u", "day", as_of).collect()}
    assert {u: s for u, (s, _, _) in found.items()} == plain
    for u, days in history.items():
        past, longest, run = [d for d in days if d <= as_of], 0, 0
        for i, d in enumerate(past):
            run = run + 1 if i and past[i - 1] == d - dt.timedelta(days=1) else 1
            longest = max(longest, run)
        if past:
            assert found[u][1:] == (longest, len(past))
