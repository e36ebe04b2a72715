"""What reaches the scan and how joins and aggregates run."""

import datetime as dt
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions import predicates as P
from millrace.operators import joins as J
from millrace.operators import layout as O
from millrace.operators import quality as Q
from millrace.operators import windows as W
from millrace.operators.layout import compare_plans, plan_features, plan_text
from millrace.operators.sequences import before_marker
from millrace.plans import QUERIES


@pytest.fixture(scope="module")
def orders(spark, folder):
    return spark.read.parquet(f"{folder}/orders.parquet")


def pushed(df):
    return plan_features(df)["pushed"]


def test_date_ranges_are_pushed(orders):
    assert "GreaterThanOrEqual" not in pushed(orders.filter(F.year("o_orderdate") == 1997))
    for condition in (P.in_year("o_orderdate", 1997), P.on_day("o_orderdate", dt.date(1997, 1, 3))):
        found = pushed(orders.filter(condition))
        assert "GreaterThanOrEqual(o_orderdate" in found and "LessThan(o_orderdate" in found


def test_keyset_bound_is_pushed(orders):
    after = P.past_key([("o_orderdate", True), ("o_orderkey", True)], [F.lit(dt.date(1998, 1, 1)), F.lit(5)])
    assert "LessThanOrEqual(o_orderdate" in pushed(orders.filter(after))
    assert "IsNull(o_orderdate" in pushed(orders.filter(after))


def test_text_filters_are_pushed(spark, folder):
    part = spark.read.parquet(f"{folder}/part.parquet")
    assert "StringStartsWith" in pushed(part.filter(F.col("p_name").startswith("small")))
    assert "StringEndsWith" in pushed(part.filter(F.col("p_name").endswith("ring")))


def test_only_needed_columns_are_read(spark, folder):
    schema = plan_features(QUERIES["sales_by_region"](spark, folder))["read_schema"]
    assert schema == "struct<o_totalprice:double,o_orderpriority:string>"
    assert "GreaterThan(o_totalprice,0.0)" in pushed(QUERIES["sales_by_region"](spark, folder))


@pytest.mark.parametrize("name", ["sales_by_region", "rollup_active", "heavy_users", "daily_completions", "annual_totals"])
def test_hash_aggregates(spark, folder, name):
    aggregates = plan_features(QUERIES[name](spark, folder))["aggregates"]
    # MAX over the label text of an already counted key is the one sort aggregate.
    assert aggregates == ("HashAggregate; SortAggregate" if name == "rollup_active" else "HashAggregate")


def test_clustered_and_monthly_layouts(spark, orders, tmp_path):
    usage = orders.select(F.col("o_custkey").alias("sub"), F.col("o_orderdate").alias("day"), "o_orderkey")
    clustered = str(tmp_path / "clustered")
    O.write_clustered(usage.repartition(4), clustered, "sub", "day")
    assert spark.read.parquet(clustered).count() == usage.count()
    found = spark.read.parquet(clustered).filter((F.col("sub") == 7) & P.since("day", dt.date(1998, 1, 1)))
    assert "EqualTo(sub,7)" in pushed(found) and "GreaterThanOrEqual(day" in pushed(found)
    assert plan_features(found.select("day"))["read_schema"] == "struct<sub:bigint,day:timestamp_ntz>"

    months = str(tmp_path / "months")
    O.write_by_month(usage, months, "day")
    one = spark.read.parquet(months).filter(F.col("month") == "1997-03")
    assert "month" in plan_features(one)["partition_filters"]
    assert one.count() == usage.filter("date_format(day, 'yyyy-MM') = '1997-03'").count()


def test_annual_reports_compared(orders):
    def report(filtered):
        return filtered.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))

    pair = compare_plans(
        report(orders.filter(F.year("o_orderdate") == 1997)), report(orders.filter(P.in_year("o_orderdate", 1997)))
    )
    assert "GreaterThanOrEqual" not in pair["pushed"][0] and "GreaterThanOrEqual" in pair["pushed"][1]
    assert pair["aggregates"][1] == "HashAggregate"


def test_hot_pair_is_spread_over_files(spark, tmp_path):
    """Half of the rows have one key and one date."""
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 70).alias("d"), "id",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        O.write_clustered(df, str(tmp_path / "t"), "k", "d")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(str(tmp_path / "t")).where("k = 1 and d = 5").groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 3 and max(r["count"] for r in files) < 10_000


def rows_scanned(df):
    """Rows the scan handed on, after whole row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_clustering_lets_the_scan_skip(spark, tmp_path):
    usage = spark.range(0, 100_000, 1, 8).select((F.col("id") % 100).alias("sub"), F.col("id").alias("day"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        usage.write.parquet(str(tmp_path / "as_is"))
        O.write_clustered(usage, str(tmp_path / "clustered"), "sub", "day")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)

    def found(name):
        return spark.read.parquet(str(tmp_path / name)).filter("sub = 42 AND day >= 50000")

    assert found("clustered").count() == found("as_is").count() == 500
    assert rows_scanned(found("as_is")) >= 50_000
    assert rows_scanned(found("clustered")) <= 30_000


def test_outliers_are_pushed(orders):
    found = pushed(orders.filter(P.outside("o_totalprice", 1000.0, 2000.0)))
    assert "IsNull(o_totalprice)" in found and "LessThan(o_totalprice,1000.0)" in found


@pytest.fixture
def tiny_partitions(spark):
    """Settings under which a few kilobytes count as a large, skewed shuffle."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_facts(spark):
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997)
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("v"))


def test_hot_key_is_split_in_a_star_join(spark, tiny_partitions):
    facts = hot_facts(spark)
    dim = spark.range(997).select(F.col("id").alias("d"), F.concat(F.lit("name"), "id").alias("name"))
    joined = J.star(facts, [(dim, "k", "d")])
    assert joined.count() == 60_000
    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    assert "skew=true" in plan_text(joined)


def test_hot_group_is_split_before_its_marker(spark, tiny_partitions):
    turns = hot_facts(spark).withColumn("t", F.when(F.col("v") % 59_999 == 59_998, "stop").otherwise("go"))
    found = before_marker(turns, "k", "v", F.col("t") == "stop")
    found.collect()
    assert "skew=true" in plan_text(found)
    stopped = turns.filter("t = 'stop'").select("k", "v").first()
    expected = turns.filter((F.col("k") != stopped.k) | (F.col("v") < stopped.v)).count()
    assert found.count() == expected


def test_only_small_tables_are_broadcast(spark, monkeypatch):
    facts, tiers = spark.range(100).withColumnRenamed("id", "k"), spark.range(5).selectExpr("id AS k", "'x' AS tier")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan_features(J.with_small(facts, tiers, "k"))["joins"] == "BroadcastHashJoin"
        monkeypatch.setattr(J, "BROADCAST_BYTES", 10)
        assert plan_features(J.with_small(facts, tiers, "k"))["joins"] == "SortMergeJoin"
        monkeypatch.setattr(J, "BROADCAST_ROWS", 4)
        assert not J.is_small(tiers)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_meets_checks_as_one_row(spark, tiny_partitions):
    facts = hot_facts(spark)
    parents = spark.range(0, 997).filter("id <> 7").select("id")
    orphans = Q.orphans(facts, "k", parents, "id")
    assert [(r.k, r.n) for r in orphans.collect()] == [(7, facts.filter("k = 7").count())]
    # Rows are counted per key on the map side before anything is shuffled.
    plan = plan_text(orphans)
    assert plan.index("HashAggregate") < plan.index("Exchange") or "partial_count" in plan


def test_wide_rows_are_shuffled_once_to_be_compared(spark, folder, tiny_partitions):
    compared = QUERIES["lossless_rejoin"](spark, folder)
    # The only shuffle of p_name with c_name, which only whole rows have both of, would be by all columns.
    shuffles = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: (hashpartitioning\(.*?\)), ", plan_text(compared))
    whole = [by for columns, by in shuffles if "c_name" in columns and "p_name" in columns]
    assert len(whole) == 1 and re.fullmatch(r"hashpartitioning\(l_orderkey#\d+L?, \d+\)", whole[0])
    assert compared.collect()[0].asDict() == {"different": 0, "same": True}


def test_hot_key_is_split_when_rows_are_compared(spark, tiny_partitions):
    facts = hot_facts(spark)
    dim = spark.range(997).select(F.col("id").alias("k"), F.concat(F.lit("name"), "id").alias("name"))
    other = dim.withColumn("name", F.when(F.col("k") == 7, "none").otherwise(F.col("name")))
    wide = facts.join(dim, "k").select("v", "k", "name")
    n = facts.filter("k = 7").count()
    found = Q.counted_differences(Q.rejoined_differences(wide, facts, other, "k"))
    assert [tuple(r) for r in found.collect()] == [(2 * n, False)]
    assert "skew=true" in plan_text(found)


def test_month_positions_do_not_shuffle_by_month(spark, folder):
    usage = spark.read.parquet(f"{folder}/orders.parquet")
    monthly = W.monthly_totals(usage, "o_custkey", "o_orderdate", "o_totalprice")
    plan = plan_text(W.numbered_in_month(monthly, "o_custkey"))
    assert "hashpartitioning(month" not in plan


def test_bucketed_tables_join_in_place(spark, folder, orders):
    joined = QUERIES["bucketed_join"](spark, folder)
    rows_of = lambda df: sorted(map(tuple, df.collect()))
    assert "Exchange" not in plan_text(joined) and "SortMergeJoin" in plan_text(joined)
    plain = orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    assert rows_of(joined.select("o_custkey", "n")) == rows_of(plain)
    assert "Exchange" in plan_text(plain)


def test_a_hot_key_shows_in_its_bucket(spark, orders, tmp_path):
    hot = orders.select(F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).alias("key"), "o_orderkey")
    even, uneven = (O.largest_share(O.bucket_rows(df, key, 8)) for df, key in ((orders, "o_orderkey"), (hot, "key")))
    assert even < 1.5 < 2.5 < uneven
    O.write_bucketed(hot, "millrace_hot", "key", 8, str(tmp_path / "hot"))
    try:
        held = spark.table("millrace_hot").groupBy(F.regexp_extract(F.input_file_name(), r"_(\d+)\.c000", 1).cast("int").alias("bucket")).count()
        assert sorted(map(tuple, held.collect())) == sorted(map(tuple, O.bucket_rows(hot, "key", 8).collect()))
    finally:
        spark.sql("DROP TABLE millrace_hot")


def test_months_are_pruned_by_the_dimension(spark, folder):
    df = QUERIES["months_of_dimension"](spark, folder)
    assert "dynamicpruning" in plan_features(df)["partition_filters"]
    read = O.rows_read(df)
    all_rows = spark.read.parquet(f"{folder}/orders.parquet").count()
    assert df.count() <= read < all_rows / 2


def test_filters_skip_row_groups(spark, tmp_path):
    """Unsorted keys: their ranges rule out nothing, the filters rule out every group without the key."""
    keys = spark.range(0, 200_000, 1, 8).select(F.xxhash64("id").alias("key"), "id")
    there = keys.first()["key"]
    plain, filtered = str(tmp_path / "plain"), str(tmp_path / "filtered")
    keys.write.parquet(plain)
    O.write_with_filters(keys, filtered, ["key"], 30_000)
    for value, most in ((there, 25_000), (there + 1, 0)):
        look = lambda path: spark.read.parquet(path).where(F.col("key") == value)  # noqa: B023, E731
        assert sorted(map(tuple, look(plain).collect())) == sorted(map(tuple, look(filtered).collect()))
        assert O.rows_read(look(filtered)) <= most < O.rows_read(look(plain))


def test_either_column_alone_reads_few_groups(spark, tmp_path):
    """Files along the curve; a third of all rows have one key, and a date may be missing."""
    df = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).alias("key"),
        F.when(F.col("id") % 50 > 0, F.date_add(F.lit(dt.date(2020, 1, 1)), F.pmod(F.hash("id"), F.lit(1000)))).alias("day"), "id",
    )
    path = str(tmp_path / "curved")
    O.write_curved(df, path, ["key", "day"], 64)
    curved = spark.read.parquet(path)
    assert sorted(curved.agg(F.sum("id"), F.count("*")).first()) == sorted(df.agg(F.sum("id"), F.count("*")).first())
    for condition in (F.col("key") == 700, P.since("day", dt.date(2022, 7, 1))):
        found = curved.where(condition)
        assert O.rows_read(found) < 120_000 / 3
        assert rows(found.select("id")) == rows(df.where(condition).select("id"))


def test_places_on_the_curve(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1), (2, 3), (3, 3), (None, 3)], "a int, b int")
    place = O.curve_position([F.col("a"), F.col("b")], [[1, 2, 3], [1, 2, 3]], 2)
    assert [r[0] for r in df.select(place).collect()] == [0, 2, 1, 3, 13, 15, 5]
