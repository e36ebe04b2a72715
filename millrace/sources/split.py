"""One large JSON array, or CSV with line breaks in its fields, read by many tasks.

Neither can be cut at lines: whether a comma or a line break ends a record depends on everything before it. So a file is
read twice, in ranges as Spark's text source deals them out (at commas, or at line breaks), from any store Spark can read.

1. Every range says what it does to a reader in each state: where it leaves one that comes in outside a string or inside
   one, and by how much it changes the depth of brackets. A range is one row, and the rows of a file, put one after the
   other, give the state and depth at which each range begins.
2. Every range is cut at its true boundaries. What lies between two of them is a record; the ends of neighbouring ranges
   are put together. Counting the boundaries numbers the records of a file from 0.

A task holds a batch of text and a record at a time. Records are written once, since both passes have to see the same
ranges. Text that does not fit the form fails the job.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.scratch import written
from millrace.session import path_bytes

RANGE_BYTES = 64 * 2**20
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"

# States of a reader: outside strings or in one; and, added to either, behind a backslash that takes the next byte along.
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2

QUOTE, BACKSLASH, COMMA = ord('"'), ord("\\"), ord(",")
DEPTH = np.zeros(256, dtype=np.int64)
DEPTH[[ord("["), ord("{")]] = 1
DEPTH[[ord("]"), ord("}")]] = -1
MARKS = DEPTH != 0
MARKS[COMMA] = True


def fair_range(spark: SparkSession, path: str, tasks_a_core: int = 3, least: int = 1 << 16) -> int:
    """Bytes of a range, so that all cores have some, and no range is larger than RANGE_BYTES."""
    ranges = spark.sparkContext.defaultParallelism * tasks_a_core
    return max(least, min(RANGE_BYTES, path_bytes(spark, path) // ranges))


# --- JSON ----------------------------------------------------------------------------------

def _quotes(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Places of the quotes that open or close strings, and whether the byte after `data` is escaped."""
    quotes = np.flatnonzero(data == QUOTE)
    if not escaped and not (data == BACKSLASH).any():
        return quotes, False
    place = np.arange(len(data))
    other = np.maximum.accumulate(np.where(data != BACKSLASH, place, -1))
    # Backslashes in a row up to each place.
    run = place - other + ((other < 0) & escaped)
    before = np.concatenate([[int(escaped)], run[:-1]]) if len(run) else run
    return quotes[before[quotes] % 2 == 0], bool(run[-1] % 2) if len(run) else escaped


def _marks(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Places of brackets and commas outside strings, and the state after `data`."""
    quotes, escaped = _quotes(data, bool(state & ESCAPED))
    marks = np.flatnonzero(MARKS[data])
    inside = state & INSIDE
    marks = marks[(np.searchsorted(quotes, marks) + inside) % 2 == 0]
    return marks, (len(quotes) + inside) % 2 + ESCAPED * escaped


def json_step(data: bytes, state: int) -> tuple[int, int]:
    """The state after `data`, and the change of depth."""
    array = np.frombuffer(data, dtype=np.uint8)
    marks, state = _marks(array, state)
    return state, int(DEPTH[array[marks]].sum())


def json_cuts(data: bytes, state: int, depth: int) -> tuple[np.ndarray, int, int]:
    """Places where an array at the top opens, goes on to its next item or closes; state and depth after `data`."""
    array = np.frombuffer(data, dtype=np.uint8)
    marks, state = _marks(array, state)
    change = DEPTH[array[marks]]
    after = depth + np.cumsum(change)
    top = np.where(change > 0, after - change == 0, np.where(change < 0, after == 0, after == 1))
    return marks[top], state, int(after[-1]) if len(after) else depth


class JsonReader:
    """Cuts a text that comes in parts into items; an item begins with the mark that opens it."""

    separator = ","
    states = (OUTSIDE, INSIDE)  # those in which a range can begin, as it begins behind a comma

    @staticmethod
    def step(parts: list[bytes], state: int) -> tuple[int, int]:
        return json_step(b",".join(parts) + b",", state)

    def __init__(self, state: int, depth: int) -> None:
        self.state, self.depth = state, depth
        self.held: list[bytes] = []

    def feed(self, parts: list[bytes]) -> Iterator[bytes]:
        data = b",".join(parts) + b","
        cuts, self.state, self.depth = json_cuts(data, self.state, self.depth)
        at = 0
        for cut in cuts.tolist():
            yield b"".join([*self.held, data[at:cut]])
            self.held, at = [], cut
        self.held.append(data[at:])

    def rest(self) -> bytes:
        return b"".join(self.held)


# --- CSV -----------------------------------------------------------------------------------

# From the beginning of a field to the end of the line; what is left over is a quoted field that goes on.
FIELDS = re.compile(rb'(?:(?>"(?>[^"]|"")*+"[^,]*+|[^",][^,]*+|)(?:,|\Z))*+')
# From within a quoted field to its end.
QUOTED = re.compile(rb'(?>[^"]|"")*+')
REST = re.compile(rb'"[^,]*+(?:,|\Z)')


def csv_step(line: bytes, state: int) -> int:
    """Whether a reader stands in a quoted field after a line (without its line break)."""
    at = 0
    if state == INSIDE:
        at = QUOTED.match(line).end()
        closed = REST.match(line, at)
        if not closed:
            return INSIDE
        at = closed.end()
        if at == len(line) and line[at - 1 : at] != b",":
            return OUTSIDE
    return OUTSIDE if FIELDS.match(line, at).end() == len(line) else INSIDE


class CsvReader:
    """Cuts lines that come in parts into records."""

    separator = "\n"
    states = (OUTSIDE, INSIDE)

    @staticmethod
    def step(parts: list[bytes], state: int) -> tuple[int, int]:
        for line in parts:
            if b'"' in line:  # other lines change nothing
                state = csv_step(line, state)
        return state, 0

    def __init__(self, state: int, depth: int) -> None:
        self.state = state
        self.held: list[bytes] = []

    def feed(self, parts: list[bytes]) -> Iterator[bytes]:
        for line in parts:
            self.held.append(line)
            if b'"' in line:
                self.state = csv_step(line, self.state)
            if self.state == OUTSIDE:
                yield b"\n".join(self.held)
                self.held = []

    def rest(self) -> bytes:
        """With a line break, as more lines follow."""
        return b"".join(x + b"\n" for x in self.held)


# --- ranges --------------------------------------------------------------------------------

Reader = type[JsonReader] | type[CsvReader]


@contextmanager
def _ranges_of(spark: SparkSession, range_bytes: int) -> Iterator[None]:
    before = spark.conf.get(SPLIT_BYTES)
    spark.conf.set(SPLIT_BYTES, str(range_bytes))
    try:
        yield
    finally:
        spark.conf.set(SPLIT_BYTES, before)


def _parts(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Rows (path, start, text) between separators, in order within a range; `start` tells the ranges of a file apart."""
    return spark.read.text(path, lineSep=separator).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("text")
    )


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[bytes]]]:
    """The parts of a batch by the range they belong to: all columns but the text, which comes last."""
    for batch in batches:
        *keys, text = batch.columns
        if not batch.num_rows:
            continue
        starts = np.asarray(batch.column("start"))
        paths = batch.column("path").dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero((starts[1:] != starts[:-1]) | (paths[1:] != paths[:-1])) + 1
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            yield tuple(k[low].as_py() for k in keys), text[low:high].to_pylist()


SUMMARY = "path string, start bigint, ends array<int>, changes array<bigint>"
SUMMARY_SCHEMA = pa.schema([
    ("path", pa.string()), ("start", pa.int64()), ("ends", pa.list_(pa.int32())), ("changes", pa.list_(pa.int64())),
])


def _summed(reader: Reader):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tracks = None, []

        def row() -> pa.RecordBatch:
            one = {"path": now[0], "start": now[1], "ends": [s for s, _ in tracks], "changes": [c for _, c in tracks]}
            return pa.RecordBatch.from_pylist([one], schema=SUMMARY_SCHEMA)

        for key, parts in _by_range(batches):
            if key != now:
                if now:
                    yield row()
                now, tracks = key, [(s, 0) for s in reader.states]
            stepped = [reader.step(parts, s) for s, _ in tracks]
            tracks = [(s, before + c) for (s, c), (_, before) in zip(stepped, tracks)]
        if now:
            yield row()

    return run


BEGINS = "path string, start bigint, state int, depth bigint, last boolean"
BEGINS_SCHEMA = pa.schema([
    ("path", pa.string()), ("start", pa.int64()), ("state", pa.int32()), ("depth", pa.int64()), ("last", pa.bool_()),
])


def _composed(reader: Reader):
    """State and depth at the beginning of each range of a text, and once more at the end of the text."""
    def run(ranges: pa.Table) -> pa.Table:
        state, depth, rows = OUTSIDE, 0, []
        for r in ranges.sort_by([("path", "ascending"), ("start", "ascending")]).to_pylist():
            rows.append({"path": r["path"], "start": r["start"], "state": state, "depth": depth, "last": False})
            track = reader.states.index(state)
            state, depth = r["ends"][track], depth + r["changes"][track]
        rows.append({"path": r["whole"], "start": -1, "state": state, "depth": depth, "last": True})
        return pa.Table.from_pylist(rows, schema=BEGINS_SCHEMA)

    return run


CUT = "path string, start bigint, n bigint, edge boolean, text binary"
CUT_SCHEMA = pa.schema([("path", pa.string()), ("start", pa.int64()), ("n", pa.int64()), ("edge", pa.bool_()), ("text", pa.binary())])


def _cut(reader: Reader):
    """Records of each range, numbered; the first may have begun earlier, and the last may go on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_, n = None, None, 0

        def rows(texts: list[bytes], edges: list[bool]) -> pa.RecordBatch:
            many = len(texts)
            return pa.RecordBatch.from_arrays([
                pa.array([now[0]] * many, pa.string()), pa.array([now[1]] * many, pa.int64()), pa.array(range(n, n + many), pa.int64()),
                pa.array(edges, pa.bool_()), pa.array(texts, pa.binary()),
            ], schema=CUT_SCHEMA)

        for key, parts in _by_range(batches):
            if key[:2] != (now and now[:2]):
                if now:
                    yield rows([open_.rest()], [True])
                now, n = key, 0
                open_ = reader(key[2], key[3])
            texts = list(open_.feed(parts))
            if texts:
                yield rows(texts, [n == 0] + [False] * (len(texts) - 1))
                n += len(texts)
        if now:
            yield rows([open_.rest()], [True])

    return run


def _records(spark: SparkSession, path: str, reader: Reader, range_bytes: int, one_text: bool = False) -> tuple[DataFrame, list]:
    """Rows (path, n, text) of the texts between boundaries, and what the texts end in: rows (path, state, depth).

    A file is a text, or with `one_text` all files are one, in the order of their paths.
    """
    whole = F.lit(path) if one_text else F.col("path")
    with _ranges_of(spark, range_bytes):
        summaries = written(_parts(spark, path, reader.separator).mapInArrow(_summed(reader), SUMMARY), "ranges")
        begins = written(summaries.withColumn("whole", whole).groupBy("whole").applyInArrow(_composed(reader), BEGINS), "begins")
        # One row a range. The join must not move the parts out of their order.
        known = F.broadcast(begins.where("not last").drop("last"))
        parts = _parts(spark, path, reader.separator).join(known, ["path", "start"]).select("path", "start", "state", "depth", "text")
        cut = written(parts.mapInArrow(_cut(reader), CUT).withColumn("whole", whole), "records")
    ends = begins.where("last").select("path", "state", "depth")
    # A range's last text has the number of its boundaries.
    sizes = cut.groupBy("whole", "path", "start").agg(F.max("n").alias("own"))
    earlier = Window.partitionBy("whole").orderBy("path", "start").rowsBetween(Window.unboundedPreceding, -1)
    bases = F.broadcast(sizes.select("path", "start", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("base")))
    placed = cut.join(bases, ["path", "start"]).withColumn("n", F.col("base") + F.col("n"))
    # A record that lies in several ranges.
    joined = placed.where("edge").groupBy("whole", "n").agg(
        F.array_sort(F.collect_list(F.struct("path", "start", "text"))).alias("parts")
    ).select(
        F.col("whole").alias("path"), "n", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.text))").alias("text")
    )
    inner = placed.where("not edge").select(F.col("whole").alias("path"), "n", "text")
    return inner.union(joined).select("path", "n", F.decode("text", "utf-8").alias("text")), ends


def array_items(
    spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, name: str | None = None, one_text: bool = False
) -> DataFrame:
    """Rows (path, row, item) of files that each hold one JSON array: the text of each item and its place from 0.

    With `name` the files have the form `name = [ ... ]`. Anything else fails the job. With `one_text` the files of the
    folder are one array, cut behind commas that separate items or lie anywhere else; all but the last end in such a comma.
    """
    texts, ends = _records(spark, path, JsonReader, range_bytes, one_text)
    bad = ends.where((F.col("state") != OUTSIDE) | (F.col("depth") != 0)).take(1)
    if bad:
        raise ValueError(f"not a JSON array: {bad[0].path}")
    sizes = texts.groupBy("path").agg(F.max("n").alias("last"))  # a row a file
    edges = written(texts.join(F.broadcast(sizes), "path").where("n < 2 or n = last"), "edges")
    before = rf"^\s*{re.escape(name)}\s*=\s*$" if name else r"^\s*$"
    # The text after the array ends in the comma that the last part was given.
    fits = (
        F.when(F.col("n") == 0, F.col("text").rlike(before) & (F.col("last") >= 2))
        .when(F.col("n") == F.col("last"), F.col("text").rlike(r"^\]\s*,?$"))
        .otherwise(F.startswith("text", F.lit("[")))
    )
    bad = edges.where(~fits).take(1)
    if bad:
        raise ValueError(f"no list is assigned to {name}: {bad[0].path}" if name else f"not a JSON array: {bad[0].path}")
    empty = edges.where("n = 1 and last = 2 and text rlike '^.\\\\s*$'").select("path")
    items = texts.join(F.broadcast(edges.where("n = 0").select("path", "last")), "path").where("n > 0 and n < last")
    items = items.join(F.broadcast(empty), "path", "left_anti")
    other = F.raise_error(F.concat(F.lit("not a JSON array: "), "path")).cast("string")
    item = F.when((F.col("n") == 1) | F.startswith("text", F.lit(",")), F.substr("text", F.lit(2))).otherwise(other)
    # A condition on an item may be looked at before what lies around the array is left out.
    item = F.when((F.col("n") > 0) & (F.col("n") < F.col("last")), item)
    return items.select("path", (F.col("n") - 1).alias("row"), item.alias("item"))


def csv_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows (path, row, record) of CSV files: the text of each record, without its line break, and its place from 0.

    Fields may hold line breaks in quotes. Blank lines are left out but counted. Lines end in \\n or \\r\\n.
    """
    texts, ends = _records(spark, path, CsvReader, range_bytes)
    bad = ends.where(F.col("state") != OUTSIDE).take(1)
    if bad:
        raise ValueError(f"a quoted field does not end: {bad[0].path}")
    record = F.regexp_replace("text", r"\r?\n?$", "")
    return texts.select("path", F.col("n").alias("row"), record.alias("record")).where("record <> ''")
