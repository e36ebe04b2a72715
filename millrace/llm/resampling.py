"""Resampling documents towards a target distribution by the importance of their hashed n-grams.

Both tables are counted into buckets of n-grams. A bucket's gain is the logarithm of how much more common it is in the
target, a document's weight the sum of the gains of all its n-grams, and the documents drawn are those with the highest
weight plus seeded Gumbel noise, which is sampling without replacement in proportion to the weights.

A task reads its texts as bytes, batch by batch. The n-grams of a batch are interned in an open-addressed NumPy table:
the slot of an n-gram is found from its xxhash64 and confirmed byte by byte, and holds the bucket and the count. Counting
adds the slots up; weighing puts a gain into each slot and gathers the gains by the slots of the occurrences. What tasks
send for counting is a row a bucket at most. The gains, one long a bucket, go to all tasks.

Null and empty texts have no words: n_features and weight are 0 and they are never drawn. Texts of any length are read in
stretches of `STRETCH` bytes, a word longer than that as a whole. Repeated rows are rows of their own; of equal scores and
identifiers the order is by text. A null identifier comes last among equal scores and is written as an empty string where
the noise is drawn. An empty table gives no rows, an empty target no counts.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.operators.ordered import numbered

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
STRETCH = 1 << 22  # bytes of text that a table is made for

# Words are 0-9, a-z, A-Z (lower-cased) and all that is not ASCII, which is every byte from 0x80 on.
WORD_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
OTHER_BYTE = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
# The five primes of xxhash64.
P1, P2, P3, P4, P5 = (
    np.uint64(p)
    for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)
SHORT = 32  # bytes; longer keys are hashed and compared one by one
BLANK = 0x20


def _lowered() -> np.ndarray:
    """The lower-cased byte for each byte of a word, 0 for others."""
    table = np.zeros(256, dtype=np.uint8)
    for b in range(256):
        if WORD_BYTES.fullmatch(bytes([b])):
            table[b] = bytes([b]).lower()[0]
    return table


LOWERED = _lowered()


class Words:
    """The words of a buffer, in order, each followed by one blank; n-grams are stretches of `flat`."""

    def __init__(self, raw: bytes) -> None:
        """`raw` ends in a byte outside words."""
        low = LOWERED[np.frombuffer(raw, dtype=np.uint8)]
        inside = low > 0
        after = np.zeros_like(inside)
        after[1:] = inside[:-1]
        flat = low[inside | after]
        flat[flat == 0] = BLANK
        self.raw_ends = np.flatnonzero(after & ~inside)
        self.ends = np.flatnonzero(flat == BLANK)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1])[: len(self.ends)]
        self.flat = np.concatenate([flat, np.zeros(SHORT, dtype=np.uint8)])
        # Eight bytes from any place on.
        self.lanes = np.ndarray((len(self.flat) - 7,), dtype="<u8", buffer=self.flat, strides=(1,))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxhash64(words: Words, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """xxhash64 with seed 0 of stretches of `words.flat`."""
    import xxhash

    h = lengths.astype(np.uint64) + P5
    for lane in range(SHORT // 8 - 1):
        at = np.flatnonzero(lengths >= 8 * lane + 8)
        if not len(at):
            break
        part = _turned(words.lanes[starts[at] + 8 * lane] * P2, 31) * P1
        h[at] = _turned(h[at] ^ part, 27) * P1 + P4
    at = np.flatnonzero(lengths & 4)
    part = words.lanes[starts[at] + (lengths[at] & ~7)] & np.uint64(0xFFFFFFFF)
    h[at] = _turned(h[at] ^ (part * P1), 23) * P2 + P3
    for k in range(3):
        at = np.flatnonzero((lengths & 3) > k)
        part = words.flat[starts[at] + (lengths[at] & ~3) + k].astype(np.uint64)
        h[at] = _turned(h[at] ^ (part * P5), 11) * P1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(lengths >= SHORT).tolist():
        h[i] = xxhash.xxh64_intdigest(words.flat[starts[i] : starts[i] + lengths[i]].data)
    return h


def _same_bytes(words: Words, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether stretches of `lengths` bytes from `a` and from `b` on are equal."""
    same = np.ones(len(a), dtype=bool)
    for lane in range(SHORT // 8):
        at = np.flatnonzero((lengths > 8 * lane) & (lengths < SHORT))
        if not len(at):
            break
        rest = np.minimum(8, lengths[at] - 8 * lane).astype(np.uint64)
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * rest)
        differ = (words.lanes[a[at] + 8 * lane] ^ words.lanes[b[at] + 8 * lane]) & mask
        same[at] &= differ == 0
    for i in np.flatnonzero(lengths >= SHORT).tolist():
        n = lengths[i]
        same[i] = np.array_equal(words.flat[a[i] : a[i] + n], words.flat[b[i] : b[i] + n])
    return same


class Table:
    """Distinct n-grams of a batch. `slots` has the slot of each occurrence; a slot in use has a bucket and a count."""

    def __init__(self, words: Words, starts: np.ndarray, lengths: np.ndarray, buckets: int, keys: np.ndarray | None = None) -> None:
        n = len(starts)
        keys = xxhash64(words, starts, lengths) if keys is None else keys
        size = 1 << max(4, (2 * n).bit_length())
        last = size - 1
        owner = np.full(size, -1, dtype=np.int64)  # the occurrence that came into a slot first
        self.slots = (keys & np.uint64(last)).astype(np.int64)
        open_ = np.arange(n)
        while len(open_):
            at = self.slots[open_]
            free = owner[at] < 0
            owner[at[free]] = open_[free]
            held = owner[at]
            met = (keys[held] == keys[open_]) & (lengths[held] == lengths[open_])
            other = np.flatnonzero(met & (held != open_))
            met[other] = _same_bytes(words, starts[held[other]], starts[open_[other]], lengths[open_[other]])
            open_ = open_[~met]
            self.slots[open_] = (self.slots[open_] + 1) & last
        self.used = np.flatnonzero(owner >= 0)
        first, flat = owner[self.used], words.flat.data
        self.bucket = np.zeros(size, dtype=np.int64)
        self.bucket[self.used] = [
            zlib.crc32(flat[s:e]) % buckets
            for s, e in zip(starts[first].tolist(), (starts[first] + lengths[first]).tolist())
        ]
        self.count = np.bincount(self.slots, minlength=size)


def _stretches(text: bytes, n: int, most: int) -> Iterator[tuple[bytes, int]]:
    """Stretches of a text with the n - 1 words before them, and how many words those are."""
    before: list[bytes] = []
    at = 0
    while len(text) - at > most:
        cut = OTHER_BYTE.search(text, at + most)
        if not cut:
            break
        part = text[at : cut.end()]
        yield b" ".join([*before, part]), len(before)
        before = [*before, *WORD_BYTES.findall(part)][-(n - 1) :] if n > 1 else []
        at = cut.end()
    yield b" ".join([*before, text[at:]]), len(before)


def _gathered(texts: list[bytes | None], n: int, most: int) -> Iterator[list[tuple[int, bytes, int]]]:
    """Lists of (row, stretch, words known before) of about `most` bytes."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for part, known in _stretches(text or b"", n, most):
            held.append((row, part, known))
            size += len(part)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def _tables(texts: list[bytes | None], n: int, buckets: int, most: int) -> Iterator[tuple[Table, np.ndarray, np.ndarray]]:
    """For each batch of texts: its table, the row of each occurrence, and the row of each word."""
    for held in _gathered(texts, n, most):
        raw = b"\n".join([part for _, part, _ in held]) + b"\n"
        words = Words(raw)
        ends = np.cumsum([len(part) + 1 for _, part, _ in held]) - 1
        upto = np.searchsorted(words.raw_ends, ends, side="right")
        of = np.repeat(np.arange(len(held)), np.diff(upto, prepend=0))  # the stretch of each word
        row = np.array([r for r, _, _ in held], dtype=np.int64)
        known = np.array([k for _, _, k in held], dtype=np.int64)
        place = np.arange(len(of)) - np.concatenate([[0], upto[:-1]])[of]  # of a word in its stretch
        starts, lengths, rows = [], [], []
        for k in range(1, n + 1):
            j = np.arange(len(of) - k + 1)
            j = j[(of[j] == of[j + k - 1]) & (place[j + k - 1] >= known[of[j]])]
            starts.append(words.starts[j])
            lengths.append(words.ends[j + k - 1] - words.starts[j])
            rows.append(row[of[j]])
        new = place >= known[of]
        yield Table(words, np.concatenate(starts), np.concatenate(lengths), buckets), np.concatenate(rows), row[of[new]]


COUNTS_SQL = "bucket bigint, n bigint"


def _count(batches: Iterator[pa.RecordBatch], n: int, buckets: int, most: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for table, _, _ in _tables(batch.column(0).to_pylist(), n, buckets, most):
            np.add.at(total, table.bucket[table.used], table.count[table.used])
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])


def bucket_counts(
    docs: DataFrame, text_col: str = "text", n: int = 1, buckets: int = BUCKETS, stretch: int = STRETCH
) -> np.ndarray:
    """Occurrences of n-grams of 1 to `n` words by bucket, over all rows; `buckets` longs."""
    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    counted = texts.mapInArrow(functools.partial(_count, n=n, buckets=buckets, most=stretch), COUNTS_SQL)
    found = np.zeros(buckets, dtype=np.int64)
    for bucket, times in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket
        found[bucket] = times
    return found


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    all_own, all_target = float(own.sum() + len(own)), float(target.sum() + len(target))
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * all_own / ((s + 1.0) * all_target))) for s, t in zip(own.tolist(), target.tolist())
    ], dtype=np.int64)


WEIGHED_SQL = "id bigint, tag bigint, n_words bigint, n_features bigint, weight bigint"


def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray, n: int, most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        weight, features, words = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
        for table, rows, word_rows in _tables(batch.column("text").to_pylist(), n, len(gain), most):
            in_slot = gain[table.bucket]
            np.add.at(weight, rows, in_slot[table.slots])
            features += np.bincount(rows, minlength=batch.num_rows)
            words += np.bincount(word_rows, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("tag"), *[pa.array(x) for x in (words, features, weight)]],
            names=["id", "tag", "n_words", "n_features", "weight"],
        )


def weighed(
    docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", n: int = 1, stretch: int = STRETCH
) -> DataFrame:
    """Rows (id, tag, n_words, n_features, weight) of every row of `docs`; `tag` tells texts under one identifier apart."""
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"),
        F.col(text_col).cast("binary").alias("text"),
    )
    return texts.mapInArrow(functools.partial(_weigh, gain=gain, n=n, most=stretch), WEIGHED_SQL)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    n: int = 1,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
    stretch: int = STRETCH,
) -> DataFrame:
    """Rows (id, tag, n_words, n_features, weight, score, rank) of every row of `docs`.

    Of the documents with at least `least_words` words, `percent` in a hundred are drawn; `rank` counts them from 1 in
    order of score and is null for the others.
    """
    gain = gains(bucket_counts(docs, text_col, n, buckets, stretch), bucket_counts(target, target_col, n, buckets, stretch))
    noise = F.conv(
        F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10
    ).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    scored = stored(
        weighed(docs, gain, id_col, text_col, n, stretch).select(
            "*", (F.col("weight") + gumbel).alias("score"), (F.col("n_words") >= least_words).alias("may")
        ),
        "weighed",
    ).df
    drawn = scored.where("may").count() * percent // 100
    order = [F.desc("may"), F.desc("score"), F.asc_nulls_last("id"), F.col("tag")]
    placed = numbered(scored, order, name="place")
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    return placed.select("id", "tag", "n_words", "n_features", "weight", "score", rank.alias("rank"))
