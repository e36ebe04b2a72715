"""Readers, writers and the rules for records."""

import json

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import quality as Q
from millrace.operators import types
from millrace.sources import files, tables

FIELDS = "region string, month string, amount double, category string"

RECORDS = [
    {"region": "", "month": "2023-07", "amount": 40, "category": "tea"},
    {"region": "north", "month": "2023-07", "amount": 40, "category": "tea"},
    {"region": "south", "month": "2023-08", "amount": 0, "category": "tea"},
    {"region": "east", "month": "2023-09", "amount": 7.5, "category": None},
    {"region": "west", "month": "", "amount": 1},
]
EDGES = [
    {"region": " ", "month": "m", "amount": "12", "extra": [1, 2]},
    {"region": 5, "month": "m", "amount": 1},
    {"region": None, "month": "m", "amount": 0},
    {"month": "m", "amount": "many", "category": 3},
    {"region": "r", "month": "m", "amount": "Infinity"},
    {"region": "r", "month": "m", "amount": "NaN"},
]


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_array(spark, tmp_path):
    path = put(tmp_path / "a.json", json.dumps(RECORDS, indent=2))
    df = files.read_json_array(spark, path, FIELDS)
    assert df.count() == 5
    assert df.filter("region = 'east'").first().category is None


def test_records_keep_their_types(spark, tmp_path):
    path = put(tmp_path / "a.json", json.dumps(RECORDS + EDGES, ensure_ascii=False, indent=2))
    checked = Q.judged_records(files.read_json_records(spark, path))
    errors = {r.row: r.error for r in Q.error_rows(checked, "row").collect()}
    text, number = "must be text of at least 1 character", "must be a number greater than 0"
    assert errors == {
        0: f"region: {text}",
        2: f"amount: {number}",
        4: f"month: {text}",
        6: f"region: {text}",
        7: f"region: {text}; amount: {number}",
        8: f"region: {text}; amount: {number}; category: must be text",
        10: f"amount: {number}",
    }
    valid = {r.row: r.amount for r in Q.valid_rows(checked).collect()}
    assert valid == {1: 40, 3: 7.5, 5: 12, 9: float("inf")}


def test_shapes_of_numbers(spark):
    good, bad = ["12", " 1.5 ", "1e3", "+.5", "Infinity"], ["12d", "0x1p3", "1f", "1_0", "", "nan", "-1", "many", "1e", "."]
    df = spark.createDataFrame([(x,) for x in good + bad], "x string")
    assert sorted(r.x for r in Q.valid_rows(Q.judged(df, [Q.positive_number("x")])).collect()) == sorted(good)


def test_rules_on_columns(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, " ", "m", 1.0), (1, None, "m", nan), (2, "r", "", None), (3, "r", "m", inf), (4, "", None, -1.0)]
    df = spark.createDataFrame(data, "row int, region string, month string, amount double")
    checked = Q.judged(df, Q.sales_rules())
    assert rows(Q.valid_rows(checked), "row") == [(0,), (3,)]
    counts = {r.row: r.n for r in checked.select("row", F.size("errors").alias("n")).collect()}
    assert counts == {0: 0, 1: 2, 2: 2, 3: 0, 4: 3}


def test_assigned_list(spark, tmp_path):
    path = put(tmp_path / "a.json", 'sales = [\n  {"region": "서울", "amount": 1500},\n  {"region": "부산", "amount": 800}\n]\n')
    df = files.read_assigned_list(spark, path, "sales", "region string, amount bigint")
    assert rows(df) == [(0, "서울", 1500), (1, "부산", 800)]
    for text in ("cost = []", "sales = [1, 2", "import os"):
        other = put(tmp_path / "b.json", text)
        with pytest.raises(Exception, match="no list is assigned to sales"):
            files.read_assigned_list(spark, other, "sales", "region string").collect()


def test_string_list(spark, tmp_path):
    path = put(tmp_path / "tips.json", '[\n  "첫째",\n  "second"\n]\n')
    assert rows(files.read_string_list(spark, path)) == [(0, "첫째"), (1, "second")]


def test_missing_and_broken_files(spark, tmp_path):
    assert files.json_if_there(spark, str(tmp_path / "none.json"), FIELDS) is None
    assert files.csv_if_there(spark, str(tmp_path / "none.csv"), ["a"]) is None
    assert files.json_if_there(spark, put(tmp_path / "bad.json", '[{"region": '), FIELDS) is None
    mistyped = RECORDS + [{"region": "late", "amount": "many"}]
    good = files.json_if_there(spark, put(tmp_path / "good.json", json.dumps(mistyped)), FIELDS)
    assert good.count() == 6 and good.columns == ["region", "month", "amount", "category"]
    assert good.filter("region = 'late'").first().amount is None


def test_csv(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'date,region,amount\r\n2024-01-05,"a ""quoted"", name",\r\n,b,2\r\n')
    assert rows(files.read_csv_text(spark, path, ["date", "region", "amount"])) == [
        ("", "b", "2"), ("2024-01-05", 'a "quoted", name', "")
    ]
    typed = files.read_csv_typed(spark, path, "date date, region string, amount bigint", {"amount": "double"})
    assert typed.schema["amount"].dataType.simpleString() == "double"
    assert typed.filter("date IS NULL").first().amount == 2.0

    out = str(tmp_path / "out")
    files.write_csv(typed, out, ["amount", "date", "region"])
    assert rows(files.read_csv_typed(spark, out, "amount double, date date, region string").select(typed.columns)) == rows(typed)


def test_csv_columns_go_by_name(spark, tmp_path):
    path = put(tmp_path / "a.csv", "b,a\n1,x\n2,y\n")
    assert rows(files.read_csv_typed(spark, path, "a string, b int")) == [("x", 1), ("y", 2)]
    with pytest.raises(AnalysisException):
        files.read_csv_text(spark, path, ["a", "c"])


def test_csv_value_that_cannot_be_read(spark, tmp_path):
    path = put(tmp_path / "a.csv", "a,b\nx,1\ny,xx\nz,\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_csv_typed(spark, path, "a string, b int").collect()
    assert rows(files.csv_misfits(spark, path, "a string, b int")) == [("b", "xx")]


def test_csv_keeps_white_space_and_lines(spark, tmp_path):
    data = [(" x ", "a\nb"), (" ", 'c, "d"'), ("\t", "\r\n"), ("", "e")]
    df = spark.createDataFrame(data, "a string, b string")
    out = str(tmp_path / "out")
    files.write_csv(df, out, ["b", "a"], multi_line=True)
    assert rows(files.read_csv_text(spark, out, ["a", "b"], multi_line=True)) == sorted(data, key=repr)
    with pytest.raises(Exception, match="line break"):
        files.write_csv(df, str(tmp_path / "other"), ["a", "b"])
    tables.csv_view(spark, "quoted_fields", put(tmp_path / "q.csv", 'a,b\n"x ""y"" z, w",2\n'), "a string, b int")
    assert rows(spark.table("quoted_fields")) == [('x "y" z, w', 2)]


def test_error_file(spark, tmp_path):
    path = str(tmp_path / "errors")
    files.write_json_lines(spark.createDataFrame([(2, "금액"), (3, None)], "row bigint, error string"), path)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ['{"row":2,"error":"금액"}', '{"row":3,"error":null}']


def test_catalog_table_is_replaced(spark, tmp_path):
    for n in (5, 3):
        df = tables.reload_table(spark.range(n).toDF("id"), "millrace_reloaded", str(tmp_path / "t"))
    assert df.count() == 3
    spark.sql("DROP TABLE millrace_reloaded")


def test_reload_count(spark):
    report = files.reload_matches(spark.range(4), spark.range(3)).first()
    assert (report.written, report.reloaded, report.same) == (4, 3, False)


def test_types_from_all_values(spark):
    columns = {
        "whole": ["1", "-2", "+3", "007"], "double": ["1", "2.5", "1e3", "-.5"], "beyond": ["1", "9223372036854775808", "2", "3"],
        "words": ["1", "inf", "NaN", "2"], "day": ["2024-02-29", "1999-12-31", "", None], "not_day": ["2024-02-30", "2024-01-01", "", ""],
        "mixed": ["2024-01-01", "5", "", ""], "spaced": [" 1", "2", "3", "4"], "none": ["", None, "", None], "text": ["1", "2", "x", "4"],
        "odd `name`": ["1", "", "", "2"],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), [c for c in columns])
    found = {r.column: (r.type, r["values"], r.nulls) for r in types.value_types(df, list(columns)).collect()}
    assert {c: t for c, (t, _, _) in found.items()} == {
        "whole": "bigint", "double": "double", "beyond": "double", "words": "double", "day": "date", "not_day": "string",
        "mixed": "string", "spaced": "string", "none": "null", "text": "string", "odd `name`": "bigint",
    }
    assert found["day"][1:] == (2, 2) and found["none"][1:] == (0, 4)
    assert types.inferred_types(df, ["day", "none"], dates=False) == {"day": "string", "none": "string"}
    assert types.inferred_types(df.where("false"), ["whole"]) == {"whole": "string"}


@pytest.mark.parametrize("last, wanted", [("12", "bigint"), ("1.5", "double"), ("n/a", "string")])
def test_a_late_misfit_widens_its_column(spark, tmp_path, last, wanted):
    """As every value counts, the last of 20,000 rows decides, also where the file is read in ranges."""
    lines = ["id,amount,day", *[f"{i},{i * 3},2024-01-0{i % 9 + 1}" for i in range(20_000)], f"20000,{last},"]
    path = put(tmp_path / "a.csv", "\n".join(lines) + "\n")
    for options in ({}, {"range_bytes": 1 << 15}):
        df = files.read_csv_inferred(spark, path, **options)
        assert dict(df.dtypes) == {"id": "bigint", "amount": wanted, "day": "date"}
        assert df.where("id = 20000").first().amount == {"bigint": 12, "double": 1.5, "string": "n/a"}[wanted]
        assert df.where("day is null").count() == 1
