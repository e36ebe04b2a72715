"""Shards of near equal bytes by histogram sort.

Rows are ordered by two keys of 60 bits: a hash of the text, so that equal texts are neighbours, and a hash of the
identifier, which orders the copies of a text. Splitters are found by counting: every round counts the exact bytes and
rows between candidate boundaries (probes) in all partitions, and opens the one cell that holds a splitter's target, as
wide as the keys in it, for the next round's probes. A round is one aggregation over keys and sizes; the driver sees a row
a cell, never one a document. A group of equal texts is kept whole if the edge of a group lies within `group_tolerance`
of the target; otherwise the group is cut between identifiers. A group of any size is cut over as many shards as it
fills. Splitters of shards are then exact to the nearest row, or to `tolerance` if one is given.

Shards larger than a task are cut into slices by further, looser splitters of the same search, and all rows, texts
included, move once, to their slice. What lies below each splitter is known, so a row's slot is its place in the slice
and the count below the slice.

Null texts have no bytes, so their size is 1, as that of empty texts, which they are told apart from by nothing else. A
null identifier is an identifier like others. Rows with equal text and identifier are one unit and go to one shard. A
table of fewer units than shards leaves shards empty; an empty table gives no rows. Other columns travel along under
their names; those of the same name as a new column go.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import discard, stored

SHARDS = 8
GROUP_TOLERANCE = 0.01  # of a shard's mean size
SLICE_BYTES = 1 << 24
KEY_BITS = 60
KEYS = 1 << KEY_BITS
PROBES = 4096  # cells of a round, for each open interval
BIN_BITS = 12
LAW = "bytes"


def size_of(text: Column) -> Column:
    """Bytes of a text in UTF-8, and one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def _hashed(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def text_key(text: Column) -> Column:
    return _hashed(F.coalesce(text, F.lit("")))


def id_key(own: Column) -> Column:
    return _hashed(F.coalesce(own.cast("string"), F.lit("")))


@dataclass
class Splitter:
    """Rows from (text, own) on lie above; `size` and `rows` lie below."""

    target: float
    tolerance: float
    group_tolerance: float
    shard: bool
    text: int = 0
    own: int = 0
    size: int = 0
    rows: int = 0


@dataclass(frozen=True)
class Interval:
    """Keys from `low` to `high`: of texts, or of identifiers under the text key `text`. `size` and `rows` lie below."""

    text: int | None
    low: int
    high: int
    size: int = 0
    rows: int = 0

    @property
    def step(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // PROBES))

    def edge(self, key: int) -> tuple[int, int]:
        return (key, 0) if self.text is None else (self.text, key)


OPEN_SCHEMA = "bin bigint, interval int, of_text bigint, low bigint, high bigint, step bigint"


def _counted(spark: SparkSession, keys: DataFrame, intervals: list[Interval]) -> dict[int, list]:
    """For each interval its cells (size, rows, least key, largest key), in order; empty ones left out."""
    own = F.when(F.col("of_text").isNull(), F.col("text_key")).otherwise(F.col("id_key"))
    sums = [F.sum("size").alias("size"), F.count("*").alias("rows"), F.min("key").alias("least"), F.max("key").alias("largest")]
    if len(intervals) == 1 and intervals[0].text is None:
        i = intervals[0]
        found = keys.where(F.col("text_key").between(i.low, i.high)).select(
            F.lit(0).alias("interval"), F.col("text_key").alias("key"), "size",
            F.expr(f"(text_key - {i.low}L) div {i.step}L").alias("cell"),
        )
    else:
        shift = KEY_BITS - BIN_BITS
        rows = []
        for n, i in enumerate(intervals):
            first, last = (i.text, i.text) if i.text is not None else (i.low, i.high)
            rows += [(b, n, i.text, i.low, i.high, i.step) for b in range(first >> shift, (last >> shift) + 1)]
        # A row for each open interval and bin: there are fewer open intervals than splitters.
        open_ = F.broadcast(spark.createDataFrame(rows, OPEN_SCHEMA))
        binned = keys.withColumn("bin", F.shiftright("text_key", shift))
        fits = F.col("of_text").isNull() | (F.col("of_text") == F.col("text_key"))
        found = (
            binned.join(open_, "bin").where(fits).withColumn("key", own).where("key between low and high")
            .select("interval", "key", "size", F.expr("(key - low) div step").alias("cell"))
        )
    cells: dict[int, list] = {n: [] for n in range(len(intervals))}
    for r in found.groupBy("interval", "cell").agg(*sums).collect():  # at most PROBES rows for each interval
        cells[r.interval].append((r.least, r.largest, r.size, r.rows))
    return {n: sorted(c) for n, c in cells.items()}


def _narrowed(splitter: Splitter, interval: Interval, cells: list) -> Interval | None:
    """Set the splitter to the nearer edge of the cell with its target; the cell, if that may be bettered."""
    size, rows = interval.size, interval.rows
    for least, largest, own_size, own_rows in cells:
        if size + own_size >= splitter.target:
            break
        size, rows = size + own_size, rows + own_rows
    else:
        raise AssertionError("a target lies outside its interval")
    lower, upper = abs(size - splitter.target), abs(size + own_size - splitter.target)
    if lower <= upper:
        (splitter.text, splitter.own), splitter.size, splitter.rows = interval.edge(least), size, rows
    else:
        (splitter.text, splitter.own), splitter.size, splitter.rows = interval.edge(largest + 1), size + own_size, rows + own_rows
    if min(lower, upper) <= splitter.tolerance:
        return None
    if least < largest:
        return Interval(interval.text, least, largest, size, rows)
    if interval.text is None and min(lower, upper) > splitter.group_tolerance:
        return Interval(least, 0, KEYS - 1, size, rows)
    return None


def splitters(
    keys: DataFrame, shards: int, tolerance: float, group_tolerance: float, slice_bytes: int
) -> list[Splitter]:
    """Splitters of shards and slices over rows (text_key, id_key, size), in order.

    Tolerances are shares of a shard's mean size.
    """
    total, largest = keys.agg(F.sum("size"), F.max("size")).first()
    if not total:
        return []
    mean = total / shards
    # No rule can do better than half of the largest row.
    group = max(group_tolerance * mean, largest / 2)
    slices = max(1, math.ceil(mean / slice_bytes))
    loose = mean / slices / 4
    wanted = [
        Splitter(total * (i // slices) / shards, tolerance * mean, group, True)
        if i % slices == 0
        else Splitter(total * i / (shards * slices), loose, loose, False)
        for i in range(1, shards * slices)
    ]
    open_: dict[Interval, list[Splitter]] = {Interval(None, 0, KEYS - 1): wanted} if wanted else {}
    while open_:
        intervals = list(open_)
        cells = _counted(keys.sparkSession, keys, intervals)
        opened: dict[Interval, list[Splitter]] = {}
        for n, interval in enumerate(intervals):
            for s in open_[interval]:
                narrower = _narrowed(s, interval, cells[n])
                if narrower:
                    opened.setdefault(narrower, []).append(s)
        open_ = opened
    return sorted(wanted, key=lambda s: (s.text, s.own, s.shard))


PLACES_SCHEMA = "bin bigint, base int, inside array<struct<text:bigint,own:bigint>>"
SLICES_SCHEMA = "slice int, shard int, start bigint"


def _places(found: list[Splitter]) -> list[tuple]:
    """For each bin of text keys: the slices that begin below it, and the splitters within it."""
    shift = KEY_BITS - BIN_BITS
    edges = [(s.text, s.own) for s in found]
    bins: dict[int, list] = {}
    for e in edges:
        bins.setdefault(e[0] >> shift, []).append(e)
    return [(b, bisect_right(edges, (b << shift, -1)), bins.get(b, [])) for b in range(1 << BIN_BITS)]


def _slices(found: list[Splitter]) -> list[tuple]:
    """For each slice its shard and the slot of its first row."""
    rows, shard, base = [(0, 0, 0)], 0, 0
    for i, s in enumerate(found, 1):
        if s.shard:
            shard, base = shard + 1, s.rows
        rows.append((i, shard, s.rows - base))
    return rows


def sharded(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    tolerance: float = 0.0,
    group_tolerance: float = GROUP_TOLERANCE,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The rows of `docs` with `size`, `shard` and `slot`, which counts the rows of a shard from 0 without gaps.

    Rows lie in the partitions of their slices, so that a writer that partitions by shard moves nothing more.
    """
    spark = docs.sparkSession
    new = ["size", "shard", "slot"]
    names = [c for c in docs.columns if c not in new or c in (id_col, text_col)]
    renamed = docs.select(*[F.col(f"`{c}`") for c in names]).toDF(*[f"c{i}" for i in range(len(names))])
    text, own = F.col(f"c{names.index(text_col)}"), F.col(f"c{names.index(id_col)}")
    keyed = {"text_key": text_key(text), "id_key": id_key(own), "size": size_of(text)}
    keys = stored(renamed.select(*[c.alias(n) for n, c in keyed.items()]), "keys")
    found = splitters(keys.df, shards, tolerance, group_tolerance, slice_bytes)
    discard(spark, keys)

    # Bounded: a row a bin, 16 bytes a splitter; a row a slice.
    places = F.broadcast(spark.createDataFrame(_places(found), PLACES_SCHEMA))
    slices = F.broadcast(spark.createDataFrame(_slices(found), SLICES_SCHEMA))
    below = F.filter(
        "inside",
        lambda s: (s["text"] < F.col("text_key")) | ((s["text"] == F.col("text_key")) & (s["own"] <= F.col("id_key"))),
    )
    in_slice = Window.partitionBy("slice").orderBy("text_key", "id_key")
    return (
        renamed.withColumns(keyed)
        # Never null, and said so: else the join would hash every text once more to find out.
        .withColumn("bin", F.coalesce(F.shiftright("text_key", KEY_BITS - BIN_BITS), F.lit(0)))
        .join(places, "bin")
        .withColumn("slice", F.col("base") + F.size(below))
        .drop("bin", "base", "inside", "size")
        .repartitionById(len(found) + 1, F.col("slice"))
        .withColumn("place", F.row_number().over(in_slice) - 1)
        .join(slices, "slice")
        .select(
            *[F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in new],
            size_of(text).alias("size"), "shard", (F.col("start") + F.col("place")).cast("bigint").alias("slot"),
        )
    )
