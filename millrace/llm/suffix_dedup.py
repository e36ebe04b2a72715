"""Byte strings of a given length that start more than once, by sorting one bucket of suffixes at a time.

Suffixes are compared over `length` bytes only. A window of that length is filed under its anchor, the k-gram in it with
the least hash; equal windows have equal anchors at the same place, so a bucket of windows with one anchor is sorted on
its own and no two buckets have to meet. Anchors that occur once, which are most, are dropped before any bytes are cut.

In a bucket, suffixes are lined up by their anchors. Ranks of a sample of places, every 16 bytes from the anchor on,
are worked out first, for strings of 16 bytes and then of twice the length each time; a tie of any length is settled by
a few of these ranks. (As suffixes are lined up, one residue is a difference cover.) From the sorted order come common
prefixes to the right and to the left of the anchor, and from these the windows that have an equal one.

Members with the same bytes all around the anchor are one member from the beginning, so copies in any number cost a
count. A bucket that still has more members than one task should hold is not sorted: its windows are counted by digest,
each on its own.

Rows that share identifier and text are separate documents with equal strings. Null texts count as empty. Rows with a
null identifier are treated like others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, stored

LENGTH = 400
GRAM = 64  # a power of two
PLACE_BITS = np.uint64(24)
CHUNK = 1 << 17
LONGEST = 1 << 22  # of a stretch that is looked at at once; below 2 ** PLACE_BITS
MOST_MEMBERS = 4096  # of a bucket that one task sorts
SAMPLE = 16

# Multipliers of the mixing function, and of the bytes.
M64 = np.uint64(0x9E3779B97F4A7C15)
N64 = np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * N64
    return x ^ (x >> np.uint64(32))


BYTE_HASH = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * M64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the strings of GRAM bytes at each place."""
    h, size = BYTE_HASH[data], 1
    while size < GRAM:
        h = _mix(h[: len(h) - size]) + h[size:]
        size *= 2
    return _mix(h)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def anchors(data: np.ndarray, bounds: np.ndarray, length: int) -> np.ndarray:
    """Rows (text, place, first window, last window, hash as int64) of the anchors, places within each text.

    `bounds` has the texts' ends in `data`, with a leading 0.
    """
    if len(data) < length:
        return np.empty((0, 5), np.int64)
    hashes = gram_hashes(data)
    packed = (hashes >> PLACE_BITS << PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_least(packed, length - GRAM + 1)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(least)]
    windows = np.flatnonzero(np.arange(len(least)) + length <= bounds[1:][text])
    if not len(windows):
        return np.empty((0, 5), np.int64)
    place = (least[windows] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    of = text[windows]
    begins = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (of[1:] != of[:-1])]))
    ends = np.concatenate([begins[1:], [len(windows)]]) - 1
    start = bounds[:-1][of[begins]]
    return np.stack(
        [of[begins], place[begins] - start, windows[begins] - start, windows[ends] - start,
         hashes[place[begins]].view(np.int64)], axis=1,
    )


def anchors_of(text: bytes, length: int = LENGTH) -> np.ndarray:
    """Anchors of one text of any length, a stretch at a time."""
    step = LONGEST - length
    found = []
    for at in range(0, max(1, len(text) - length + 1), step):
        part = np.frombuffer(text, np.uint8, min(len(text) - at, step + length - 1), at)
        rows = anchors(part, np.array([0, len(part)]), length)
        rows[:, 1:4] += at
        found.append(rows)
    return np.concatenate(found)


ANCHORS_SQL = "id bigint, tag bigint, gram bigint, place int, low int, high int"


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset))
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (size == 0 or size + sizes[end] <= CHUNK):
                size += int(sizes[end])
                end += 1
            if size > LONGEST:
                rows = anchors_of(texts[at].as_py(), length)
            else:
                own = [t.as_py() for t in texts[at:end]]
                rows = anchors(np.frombuffer(b"".join(own), np.uint8), np.cumsum([0, *sizes[at:end]]), length)
            of = pa.array(rows[:, 0])
            part = batch.slice(at, end - at)
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(of), part.column("tag").take(of), pa.array(rows[:, 4]),
                 *[pa.array(rows[:, i].astype(np.int32)) for i in (1, 2, 3)]],
                names=["id", "tag", "gram", "place", "low", "high"],
            )
            at = end


Finish = Callable[[bytes], tuple]
"""From the bytes that are left to the columns that are wanted of them."""


def whole(left: bytes) -> tuple:
    return (left,)


def remove(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and the number of runs; spans (start, end) may overlap."""
    left, removed, runs, at, reached = [], 0, 0, 0, -1
    for start, end in sorted(spans):
        if start > reached:  # spans that touch are one run
            left.append(text[at:start])
            runs += 1
            removed -= start
            removed += end
        elif end > reached:
            removed += end - reached
        reached = max(reached, end)
        at = reached
    left.append(text[at:])
    return b"".join(left), removed, runs


def _cut(batches: Iterator[pa.RecordBatch], length: int, finish: Finish, schema: pa.Schema, kinds: int) -> Iterator[pa.RecordBatch]:
    """Of a text with anchors that occur elsewhere: its compressed bytes, and the bytes around each of the anchors.

    Of a text without: what is wanted of it.
    """
    pack = zstandard.ZstdCompressor(level=1)
    none = (None,) * kinds
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            out = []
            for own, tag, text, found in zip(*[c.to_pylist() for c in batch.slice(at, 200).columns]):
                if not found:
                    out.append((0, own, tag, None, None, None, None, None, None, len(text), *finish(text)))
                    continue
                out.append((1, own, tag, None, None, None, None, None, pack.compress(text), len(text), *none))
                for a in found:
                    around = text[a["low"] : a["high"] + length]
                    digest = xxhash.xxh3_128_digest(around + (a["place"] - a["low"]).to_bytes(4, "little"))
                    out.append((2, own, tag, a["gram"], digest, a["place"], a["low"], a["high"], around, None, *none))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def sample_ranks(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Order of byte rows (of a multiple of SAMPLE bytes) by `first` and then by their bytes.

    Ranks at every SAMPLE bytes, doubled in length until a few of them cover a row.
    """
    words = rows.reshape(len(rows), -1, 8).view(">u8")[:, :, 0].astype(np.uint64)

    def ranked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        order = np.lexsort((b, a))
        new = np.concatenate([[False], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
        rank = np.empty(len(a), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    level = [ranked(words[:, i], words[:, i + 1]) for i in range(0, words.shape[1], 2)]
    keys = []
    while level:
        if len(level) % 2:
            keys.append(level.pop())
        level = [ranked(level[i], level[i + 1]) for i in range(0, len(level), 2)]
    return np.lexsort((*keys, first))


def common_prefixes(rows: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each row in order with the one before; -1 where `first` changes."""
    out = np.full(len(order), -1, np.int64)
    for at in range(1, len(order), 4096):
        a, b = order[at : at + 4096], order[at - 1 : at - 1 + len(order[at : at + 4096])]
        differ = rows[a] != rows[b]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[at : at + len(a)] = np.where(first[a] == first[b], common, -1)
    return out


def equal_windows(bucket: np.ndarray, around: list[bytes], before: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each member and each distance of a window's start before the anchor: has it an equal window?

    `bucket` numbers the members' buckets, `around` has their bytes from the first window to the end of the last one,
    `before` the bytes of these in front of the anchor. The result has length - GRAM + 1 columns.
    """
    m, most = len(around), length - GRAM
    right = np.zeros((m, -(-length // SAMPLE) * SAMPLE), np.uint8)
    left = np.zeros((m, -(-most // SAMPLE) * SAMPLE), np.uint8)
    for i, (data, a) in enumerate(zip(around, before)):
        row = np.frombuffer(data, np.uint8)
        right[i, : len(row) - a] = row[a : a + right.shape[1]]
        left[i, :a] = row[:a][::-1]
    places, starts = [], []
    for rows in (right, left):
        order = sample_ranks(rows, bucket)
        place = np.empty(m, np.int64)
        place[order] = np.arange(m)
        places.append(place)
        starts.append(common_prefixes(rows, order, bucket))
    sizes = np.array([len(a) for a in around])
    low = np.asarray(before) - (sizes - length)  # distances of the last and of the first window
    out = np.zeros((m, most + 1), bool)
    for distance in range(most + 1):
        members = np.flatnonzero((low <= distance) & (distance <= before))
        if len(members) < 2:
            continue
        to_right = np.cumsum(starts[0] < length - distance)[places[0][members]]
        to_left = np.cumsum(starts[1] < distance)[places[1][members]]
        both = to_right * (m + 1) + to_left
        order = np.argsort(both)
        same = both[order][1:] == both[order][:-1]
        out[members[order[1:][same]], distance] = True
        out[members[order[:-1][same]], distance] = True
    return out


SPANS_SQL = "id bigint, tag bigint, start int, end int"


def _ranges(flags: np.ndarray, before: int, low: int, length: int) -> list[tuple[int, int]]:
    """Spans of bytes that the flagged windows cover; flags by distance before the anchor."""
    starts = np.flatnonzero(flags[before::-1]) + low
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > length)
    firsts, lasts = starts[np.concatenate([[0], breaks + 1])], starts[np.concatenate([breaks, [len(starts) - 1]])]
    return list(zip(firsts.tolist(), (lasts + length).tolist()))


def _sorted_buckets(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of the members that are alone with their bytes; buckets come one after another."""
    names = ("gram", "n", "id", "tag", "place", "low", "around")

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        grams = np.array([r[0] for r in rows])
        bucket = np.cumsum(np.concatenate([[0], grams[1:] != grams[:-1]]))
        before = np.array([r[4] - r[5] for r in rows])
        flags = equal_windows(bucket, [r[6] for r in rows], before, length)
        out = [
            (r[2], r[3], s, e)
            for r, f, b in zip(rows, flags, before) if r[1] == 1
            for s, e in _ranges(f, b, r[5], length)
        ]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], t) for i, t in enumerate(types)], names=["id", "tag", "start", "end"]
        )

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[batch.column(n).to_pylist() for n in names]):
            if len(held) >= MOST_MEMBERS and row[0] != held[-1][0]:
                yield spans(held)
                held = []
            held.append(row)
    if held:
        yield spans(held)


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """A row for each window: its digest, and where it starts if its member is alone with its bytes."""
    for batch in batches:
        for n, own, tag, low, around in zip(*[batch.column(x).to_pylist() for x in ("n", "id", "tag", "low", "around")]):
            view = memoryview(around)
            count = len(around) - length + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(view[i : i + length]) for i in range(count)], pa.binary()),
                    pa.array([own] * count, pa.int64()),
                    pa.array([tag] * count, pa.int64()),
                    pa.array(range(low, low + count), pa.int32()),
                    pa.array([n == 1] * count, pa.bool_()),
                ],
                names=["digest", "id", "tag", "start", "alone"],
            )


def repeated_strings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    finish: Finish = whole,
    columns: dict[str, tuple[str, pa.DataType]] | None = None,
    most_members: int = MOST_MEMBERS,
) -> DataFrame:
    """Rows (id, n_bytes, n_removed, n_spans, left) of every row of `docs`; or what `finish` makes of the bytes left.

    Each byte goes that a string of `length` bytes covers which starts anywhere else too, in this text or in another.
    """
    spark = docs.sparkSession
    columns = columns or {"left": ("binary", pa.binary())}
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("tag"), text.cast("binary").alias("text")
    )
    found = stored(texts.mapInArrow(partial(_anchor_rows, length=length), ANCHORS_SQL), "anchors")
    # Written, so that the join below deals both sides out anew and a hot gram's rows can be split.
    again = stored(found.df.groupBy("gram").agg(F.count("*").alias("times")).where("times > 1").select("gram"), "again")
    by_text = (
        found.df.join(again.df, "gram")
        .groupBy(F.col("id").alias("of"), F.col("tag").alias("of_tag"))
        .agg(F.collect_set(F.struct("gram", "place", "low", "high")).alias("found"))
    )
    kept_sql = ", ".join(f"{n} {t}" for n, (t, _) in columns.items())
    schema = pa.schema([
        ("kind", pa.int32()), ("id", pa.int64()), ("tag", pa.int64()), ("gram", pa.int64()), ("digest", pa.binary()),
        ("place", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("data", pa.binary()), ("n_bytes", pa.int64()),
        *[(n, t) for n, (_, t) in columns.items()],
    ])
    cut_sql = "kind int, id bigint, tag bigint, gram bigint, digest binary, place int, low int, high int, data binary, n_bytes bigint"
    same = texts["id"].eqNullSafe(by_text["of"]) & (texts["tag"] == by_text["of_tag"])
    cut = stored(
        texts.join(by_text, same, "left").select("id", "tag", "text", "found")
        .mapInArrow(partial(_cut, length=length, finish=finish, schema=schema, kinds=len(columns)), f"{cut_sql}, {kept_sql}"),
        "cut",
    ).df
    discard(spark, found, again)

    around = cut.where("kind = 2")
    members = stored(
        around.groupBy("gram", "digest").agg(
            F.count("*").alias("n"),
            F.first(F.struct("id", "tag", "place", "low", F.col("data").alias("around"))).alias("m"),
        ).select("gram", "digest", "n", "m.*"),
        "members",
    ).df
    # Buckets in which a member is alone with its bytes, and has others to be held against.
    buckets = members.groupBy("gram").agg(F.count("*").alias("members"), F.min("n").alias("least")).where(
        "members > 1 and least = 1"
    )
    open_ = members.join(stored(buckets.drop("least"), "buckets").df, "gram")
    sorted_ = (
        open_.where(F.col("members") <= most_members)
        .select("gram", "n", "id", "tag", "place", "low", "around")
        .repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(partial(_sorted_buckets, length=length), SPANS_SQL)
    )
    windows = (
        open_.where(F.col("members") > most_members)
        .select("n", "id", "tag", "low", "around")
        .mapInArrow(partial(_windows, length=length), "digest binary, id bigint, tag bigint, start int, alone boolean")
    )
    windows = stored(windows, "windows").df
    counted = windows.groupBy("digest").agg(F.count("*").alias("times")).where("times > 1").select("digest")
    counted = windows.where("alone").join(counted, "digest").select("id", "tag", "start", (F.col("start") + length).alias("end"))
    copies = members.where("n > 1").select("gram", "digest")
    copied = around.select("id", "tag", "gram", "digest", "low", "high").join(copies, ["gram", "digest"]).select(
        "id", "tag", F.col("low").alias("start"), (F.col("high") + length).alias("end")
    )
    spans = (
        sorted_.union(counted).union(copied)
        .groupBy(F.col("id").alias("of"), F.col("tag").alias("of_tag"))
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    left_schema = pa.schema([
        ("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        *[(n, t) for n, (_, t) in columns.items()],
    ])

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                out = []
                for own, data, n_bytes, spans in zip(*[c.to_pylist() for c in batch.slice(at, 200).columns]):
                    left, gone, runs = remove(unpack.decompress(data), [(s["start"], s["end"]) for s in spans or ()])
                    out.append((own, n_bytes, gone, runs, *finish(left)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), left_schema)], schema=left_schema
                )

    packed = cut.where("kind = 1")
    same = packed["id"].eqNullSafe(spans["of"]) & (packed["tag"] == spans["of_tag"])
    touched = packed.join(spans, same, "left").select("id", "data", "n_bytes", "spans").mapInArrow(
        removed, f"id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {kept_sql}"
    )
    zero = F.lit(0).cast("bigint")
    untouched = cut.where("kind = 0").select("id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), *columns)
    return untouched.union(touched)
