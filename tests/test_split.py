"""Large arrays and CSV files read in ranges, against json.loads and csv."""

import csv
import io
import json
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.plans.files import _one_array
from millrace.sources import files, split
from millrace.sources.tables import Tables

TRICKY = ['a,b', 'say "hi"', 'back\\slash', '\\', '\\\\"', '[not, an array]', '{"k": [1, 2]}', 'line\nbreak', 'crlf\r\nend', '', ' ', '서울,부산', '"', '",', ' ', '}]']


def value(pick, depth=0):
    kind = pick.randrange(7 if depth < 3 else 4)
    if kind < 2:
        return "".join(pick.choice(TRICKY) for _ in range(pick.randrange(4)))
    if kind == 2:
        return pick.choice([0, -1.5, 10**12, True, None])
    if kind == 3:
        return pick.choice(TRICKY)
    if kind == 4:
        return [value(pick, depth + 1) for _ in range(pick.randrange(4))]
    return {pick.choice(TRICKY) + str(i): value(pick, depth + 1) for i in range(pick.randrange(4))}


def array_text(pick, n, ensure_ascii, indent):
    return json.dumps([value(pick) for _ in range(n)], ensure_ascii=ensure_ascii, indent=indent)


def put(path, text):
    path.write_bytes(text.encode())
    return str(path)


@pytest.mark.parametrize("seed", range(12))
def test_json_cut_anywhere(seed):
    """Steps of a text cut at random bytes, inside strings, escapes and characters, make the step of the whole."""
    pick = random.Random(seed)
    text = array_text(pick, 8, seed % 2 == 0, [None, 1][seed % 3 == 0])
    data = text.encode()
    places = sorted({0, len(data), *(pick.randrange(len(data)) for _ in range(30))})
    parts = [data[a:b] for a, b in zip(places, places[1:])]
    for start in (split.OUTSIDE, split.INSIDE, split.INSIDE + split.ESCAPED):
        state, depth = start, 0
        for part in parts:
            state, change = split.json_step(part, state)
            depth += change
        assert (state, depth) == split.json_step(data, start)
    state, depth, found, held = split.OUTSIDE, 0, [], b""
    for part in parts:
        cuts, state, depth = split.json_cuts(part, state, depth)
        at = 0
        for cut in cuts.tolist():
            found.append(held + part[at:cut])
            held, at = b"", cut
        held += part[at:]
    assert (state, depth, held, found[0]) == (split.OUTSIDE, 0, b"]", b"")
    assert [json.loads(x[1:]) for x in found[1:]] == json.loads(text)


@pytest.mark.parametrize("seed", range(12))
def test_csv_cut_at_any_line(seed):
    pick = random.Random(seed)
    end = ["\n", "\r\n"][seed % 2]
    text = csv_text(pick, 30, end)
    lines = text.encode().split(b"\n")
    reader, found = split.CsvReader(split.OUTSIDE, 0), []
    places = sorted({0, len(lines), *(pick.randrange(len(lines)) for _ in range(5))})
    for a, b in zip(places, places[1:]):
        # A range's effect on either state is that of the reader that came to it.
        assert split.CsvReader.step(lines[a:b], reader.state)[0] == after(lines[a:b], reader.state)
        found += reader.feed(lines[a:b])
    got = [next(csv.reader([r.decode().removesuffix("\r")] if "\n" not in r.decode() else io.StringIO(r.decode(), newline=""))) for r in found if r.strip()]
    assert got == [r for r in csv.reader(io.StringIO(text, newline="")) if r]


def after(lines, state):
    other = split.CsvReader(state, 0)
    list(other.feed(lines))
    return other.state


def csv_text(pick, n, end="\n"):
    out = io.StringIO(newline="")
    made = csv.writer(out, lineterminator=end)
    made.writerow(["id", "text", "note"])
    for i in range(n):
        made.writerow([i, "".join(pick.choice(TRICKY) for _ in range(pick.randrange(4))), pick.choice(['in "the" middle', "", "plain", " x "])])
    return out.getvalue()


def test_quotes_in_plain_fields():
    assert split.csv_step(b'a "quoted" word,b', split.OUTSIDE) == split.OUTSIDE
    assert split.csv_step(b'5" pipe,"open', split.OUTSIDE) == split.INSIDE
    assert split.csv_step(b'still open', split.INSIDE) == split.INSIDE
    assert split.csv_step(b'closed" here,"open ""again', split.INSIDE) == split.INSIDE
    assert split.csv_step(b'""",x', split.INSIDE) == split.OUTSIDE
    assert split.csv_step(b'"",""', split.OUTSIDE) == split.OUTSIDE


@pytest.mark.parametrize("range_bytes", [150, 1 << 20])
def test_arrays_in_ranges(spark, tmp_path, range_bytes):
    pick = random.Random(5)
    texts = [array_text(pick, 40, i % 2 == 0, [None, 2][i % 2]) for i in range(3)] + ["[]", " [ ]\n", '["one"]', "[\n1\n]\n"]
    for i, text in enumerate(texts):
        put(tmp_path / f"{i}.json", text)
    got = split.array_items(spark, str(tmp_path), range_bytes).collect()
    by = {}
    for r in got:
        by.setdefault(int(r.path.split("/")[-1].split(".")[0]), {})[r.row] = json.loads(r.item)
    for i, text in enumerate(texts):
        want = json.loads(text)
        assert [by.get(i, {}).get(k) for k in range(len(want))] == want and len(by.get(i, {})) == len(want)


@pytest.mark.parametrize("text", ['{"a": 1, "b": 2}', "[1, 2", '["open', "[1], [2]", "[1] x", "x [1]", "1, 2", "[1]]"])
def test_not_an_array(spark, tmp_path, text):
    with pytest.raises(Exception, match="not a JSON array"):
        split.array_items(spark, put(tmp_path / "a.json", text), 8).collect()


def test_readers_in_ranges(spark, tmp_path):
    records = [{"region": f"r{i % 3}", "amount": i, "note": TRICKY[i % len(TRICKY)]} for i in range(200)]
    fields = "region string, amount bigint, note string"
    path = put(tmp_path / "a.json", json.dumps(records, ensure_ascii=False))
    plain = files.read_json_array(spark, path, fields)
    assert rows(files.read_json_array(spark, path, fields, range_bytes=100)) == rows(plain)
    kept = files.read_json_records(spark, path, range_bytes=100).selectExpr("row", "to_json(record) as r").collect()
    assert [json.loads(r.r) for r in sorted(kept)] == records
    named = put(tmp_path / "b.py", "sales = " + json.dumps(records) + "\n")
    got = files.read_assigned_list(spark, named, "sales", fields, range_bytes=90).collect()
    assert [r.row for r in sorted(got)] == list(range(200)) and [r.note for r in sorted(got)] == [r["note"] for r in records]
    with pytest.raises(ValueError, match="no list is assigned to cost"):
        files.read_assigned_list(spark, named, "cost", fields, range_bytes=90)
    listed = put(tmp_path / "c.json", json.dumps(TRICKY * 20))
    got = files.read_string_list(spark, listed, range_bytes=64).collect()
    assert [r.item for r in sorted(got)] == TRICKY * 20
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        files.read_json_array(spark, put(tmp_path / "d.json", '[{"amount": 1}, {"amount": x}]'), fields, range_bytes=9).collect()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_in_ranges(spark, tmp_path, end):
    text = csv_text(random.Random(9), 300, end)
    path = put(tmp_path / "a.csv", text)
    got = files.read_csv_text(spark, path, ["id", "text", "note"], range_bytes=200).collect()
    want = list(csv.reader(io.StringIO(text, newline="")))[1:]
    assert sorted(map(tuple, got), key=lambda r: int(r[0])) == [tuple(r) for r in want]
    typed = files.read_csv_typed(spark, path, "note string, id bigint", range_bytes=200)
    assert typed.agg({"id": "sum"}).first()[0] == sum(range(300))
    put(tmp_path / "b.csv", "id,text\n1,x\n")
    with pytest.raises(ValueError, match="headers"):
        files.read_csv_text(spark, str(tmp_path), ["id"], range_bytes=200)
    with pytest.raises(ValueError, match="does not end"):
        files.read_csv_text(spark, put(tmp_path / "c.csv", 'a,b\n1,"x\n2,y\n'), ["a"], range_bytes=8)


def test_ranges_are_tasks(spark, tmp_path):
    """A single line of 3 MB is read by many tasks."""
    path = put(tmp_path / "a.json", json.dumps([{"n": i, "t": 'x, "y" ' * 9} for i in range(30_000)]))
    parts = split._parts(spark, path, ",")
    with split._ranges_of(spark, 1 << 17):
        assert parts.select("start").distinct().count() >= 20
    assert files.read_json_array(spark, path, "n bigint", range_bytes=1 << 17).agg({"n": "sum"}).first()[0] == sum(range(30_000))
    assert np.array_equal(split.DEPTH[[91, 93, 123, 125]], [1, -1, 1, -1])


@pytest.mark.parametrize("name", [None, "sales"])
def test_one_array_in_many_files(spark, tmp_path, name):
    """An array cut behind commas, also within strings and records, is read as if it were one file."""
    values = TRICKY * 6 + [{"a": [1, "x,y"], "b": ","}, [1, [2, 3]]]
    text = ("sales = " if name else "") + json.dumps(values, ensure_ascii=False) + "\n"
    places = [i + 1 for i, c in enumerate(text) if c == ","][2::7]
    for i, (a, b) in enumerate(zip([0, *places], [*places, len(text)])):
        folder = tmp_path / f"part={i // 10}"
        folder.mkdir(exist_ok=True)
        put(folder / f"part-{i:05}.txt", text[a:b])
    for range_bytes in (60, 1 << 20):
        got = sorted((r.row, json.loads(r.item)) for r in split.array_items(spark, str(tmp_path), range_bytes, name, one_text=True).collect())
        assert got == list(enumerate(values))
    (tmp_path / "part=9").mkdir()
    put(tmp_path / "part=9" / "part-0.txt", "]")
    with pytest.raises(Exception, match="not a JSON array|no list is assigned"):
        split.array_items(spark, str(tmp_path), 1 << 20, name, one_text=True).collect()


@pytest.mark.parametrize("n", [0, 1, 2, 5_000])
def test_one_array_is_written_by_many_tasks(spark, tmp_path, n):
    table = spark.range(n).withColumn("t", F.lit('x, "y"\n')).repartition(4)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        path = _one_array(Tables(spark, str(tmp_path)), table, "id", F.to_json(F.struct("id", "t")))
    finally:
        spark.conf.unset(coalesce)
    files_of = spark.read.format("binaryFile").load(path).orderBy("path").collect()
    assert json.loads(b"".join(f.content for f in files_of)) == [{"id": i, "t": 'x, "y"\n'} for i in range(n)]
    if n > 2:  # no task has the whole array
        assert len(files_of) > 4 and max(f.length for f in files_of) < sum(f.length for f in files_of) / 2
