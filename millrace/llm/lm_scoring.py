"""Language-model scores from a log-frequency Bloom filter.

N-gram counts are gathered over all training documents and quantised on a logarithmic scale. An n-gram of level q is in
the filter once for each level up to q, so its level is found by asking for one level after another until one is
missing. The filter has BITS_PER_ENTRY bits for each entry and grows with the corpus. It is never held whole: its segments
have about as many entries at any size, and blocks of texts send the keys of their n-grams to the segments and get levels
back. Keys are hashes, of BIGRAM_BITS bits for a bigram; they travel sorted, as differences, packed.

A bigram's probability is smoothed by its word's: (c(v w) + WEIGHT p(w)) / (c(v) + WEIGHT), with p(w) from the unigram's
estimated count and add-ADD smoothing. The base score is of exact unigram counts, which a segment keeps beside its part of
the filter and sends back with the levels.

Texts are split into words once, into blocks that hold every word's hash and the places of the tokens; counting and
scoring read these. Null texts count as empty: a single end token. A null identifier is held out. Repeated rows are
scored, and counted, each on their own. Without training documents all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, stored

SEGMENT_BYTES = 1 << 24  # of training texts for each segment of the filter, at TOKEN_BYTES for a token
TOKEN_BYTES = 6
BLOCK = 1 << 20  # tokens of texts that ask for their n-grams' levels together
BATCH = "4m"  # of blocks, keys or answers, to a Python worker at a time
OUT_BYTES = 1 << 20  # of keys or counts, from a Python worker at a time
PIECE = 1 << 16  # tokens whose keys are worked out at a time
PROBES = 5
BITS_PER_ENTRY = 10
BASE = 2**0.5
MOST_LEVELS = 96
BIGRAM_BITS = 50
PROBED = 1 << 19  # keys that are looked up at a time
WEIGHT = 500.0
ADD = 0.1
FLUSH = 4_000_000  # tokens that a task counts before it hands their counts on

# Multipliers of the mixing functions.
M64 = np.uint64(0x9E3779B97F4A7C15)
N64 = np.uint64(0xBF58476D1CE4E5B9)
END = np.uint64(xxhash.xxh3_64_intdigest(b" ") >> 1)  # no word holds a blank
PAIR = np.uint64(1 << 63)  # set in the keys of bigrams


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * N64
    return x ^ (x >> np.uint64(29))


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the words in lower case (A-Z), and of the end."""
    words = (text or "").encode().lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(1)
    out[-1] = END
    return out


def pairs(flat: np.ndarray) -> np.ndarray:
    """Keys of the bigrams that end at each token; a text begins after an end."""
    keys = np.concatenate([[END], flat])[:-1]
    for at in range(0, len(keys), PIECE):
        before, now = keys[at : at + PIECE], flat[at : at + PIECE]
        before[:] = (mix64(mix64(before * M64) + now * N64) & np.uint64((1 << BIGRAM_BITS) - 1)) | PAIR
    return keys


def sorted_once(keys: np.ndarray) -> np.ndarray:
    """The distinct keys, in order. Sorts `keys` in place."""
    keys.sort()
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def with_times(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, in order, and the sums of their times; how often they are there, if none are given. May sort `keys` in place."""
    if not len(keys):
        return keys, np.empty(0, np.int64)
    if times is None:
        keys.sort()
    else:
        order = np.argsort(keys, kind="stable")  # merges runs that are sorted already
        keys, times = keys[order], times[order]
        del order
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    begins, keys = np.flatnonzero(new), keys[new]
    if times is not None:
        return keys, np.add.reduceat(times, begins).astype(np.int64, copy=False)
    sums = np.empty(len(begins), np.int64)
    np.subtract(begins[1:], begins[:-1], out=sums[:-1])
    sums[-1] = len(new) - begins[-1]
    return keys, sums


def joined(held: list[np.ndarray]) -> np.ndarray:
    """What is held, as one array; it is held no longer."""
    out = np.concatenate(held)
    held.clear()
    return out


def packed(numbers: np.ndarray) -> bytes:
    """Byte planes, most of which are zeros for small numbers."""
    planes = np.ascontiguousarray(numbers.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Of sorted keys."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def level_of(count: np.ndarray) -> np.ndarray:
    """1 for a count of 1, one more for each factor of BASE."""
    return 1 + np.floor(np.log(count) / np.log(BASE) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    """The middle of a level; 0 for none."""
    low = BASE ** (level - 1.0)
    return np.where(level > 0, np.where(level == 1, 1.0, (np.ceil(low - 1e-9) + np.maximum(low * BASE - 1, low)) / 2), 0.0)


class Filter:
    """Membership of (key, level), in segments that are built apart."""

    def __init__(self, words: np.ndarray, least: int) -> None:
        self.words, self.least = words, least

    @staticmethod
    def places(keys: np.ndarray, level: np.ndarray | int, bits: int) -> Iterator[np.ndarray]:
        """Bits of each (key, level) within its segment."""
        h = mix64(keys * M64 + (np.atleast_1d(level).astype(np.uint64) + np.uint64(1)) * N64)
        step = mix64(h + M64) | np.uint64(1)
        for _ in range(PROBES):
            yield h % np.uint64(bits)
            h = h + step

    @staticmethod
    def segment(keys: np.ndarray, segments: int) -> np.ndarray:
        """Ranges of keys, so that a segment's keys lie close together."""
        out = np.empty(len(keys), np.int64)
        for at in range(0, len(keys), PIECE):
            piece = keys[at : at + PIECE]
            share = np.where(piece >= PAIR, (piece & ~PAIR) / 2.0**BIGRAM_BITS, piece / 2.0**63)
            out[at : at + PIECE] = np.minimum((share * segments).astype(np.int64), segments - 1)
        return out

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level up to which all levels are there; 0 for none."""
        bits = self.words.shape[1] * 64
        out = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        segment = self.segment(keys, len(self.words))
        level = self.least
        while len(alive) and level <= MOST_LEVELS:
            there = np.ones(len(alive), bool)
            for place in self.places(keys[alive], level, bits):
                word = self.words[segment[alive], (place >> np.uint64(6)).astype(np.int64)]
                there &= (word >> (place & np.uint64(63))) & np.uint64(1) == 1
            alive = alive[there]
            out[alive] = level
            level += 1
        return out


def build_segment(keys: np.ndarray, levels: np.ndarray, least: int, bits: int) -> np.ndarray:
    words = np.zeros(bits // 64, np.uint64)
    for level in range(least, int(levels.max(initial=0)) + 1):
        for place in Filter.places(keys[levels >= level], level, bits):
            np.bitwise_or.at(words, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return words


def _runs(segment: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each segment of sorted ones, and where it stands."""
    begins = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])) if len(segment) else []
    for begin, end in zip(begins, [*begins[1:], len(segment)]):
        yield int(segment[begin]), slice(begin, end)


COUNTED_SQL = "segment bigint, keys binary, counts binary"
COUNTED = pa.schema([("segment", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _counted(batches: Iterator[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    """A task's counts of n-grams of training texts by segment."""
    held: list[np.ndarray] = []  # keys of bigrams
    words_held: list[np.ndarray] = []
    times_held: list[np.ndarray] = []  # of the words

    def counts() -> Iterator[pa.RecordBatch]:
        for of_pairs in (False, True):
            found, n = with_times(joined(held)) if of_pairs else with_times(joined(words_held), joined(times_held))
            runs = _runs(Filter.segment(found, segments))
            yield from _rows(((of, packed_keys(found[at]), packed(n[at])) for of, at in runs), COUNTED)

    size = 0
    for batch in batches:
        for row in _each(batch):
            words, places = _tokens_of(row)
            places = places[np.repeat(~np.array(row["held_out"]), row["sizes"])]
            n = np.bincount(places, minlength=len(words))
            words_held.append(words[n > 0])
            times_held.append(n[n > 0])
            held.append(pairs(words[places]))
            size += len(places)
            if size >= FLUSH:
                yield from counts()
                size = 0
    if size:
        yield from counts()


def _rows(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A few hundred rows together, or fewer if they are large."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) == 200 or size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held.clear()
            size = 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


BUILT_SQL = "segment bigint, words binary, keys binary, counts binary, total bigint, known bigint"
BUILT = pa.schema([
    ("segment", pa.int64()), ("words", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary()), ("total", pa.int64()), ("known", pa.int64()),
])


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The filter and the exact unigram counts of each segment, whose rows come one after another."""
    held: list[np.ndarray] = []
    times: list[np.ndarray] = []

    def built(segment: int) -> Iterator[pa.RecordBatch]:
        keys, counts = with_times(joined(held), joined(times))
        ones = keys < PAIR
        words = segment_filter(keys, level_of(counts)).tobytes()
        exact = counts[ones]
        yield from _rows([(segment, words, packed_keys(keys[ones]), packed(exact), int(exact.sum()), len(exact))], BUILT)

    now = None
    for batch in batches:
        for segment, keys, counts in zip(*[batch.column(n).to_pylist() for n in COUNTED.names]):
            if held and segment != now:
                yield from built(now)
            now = segment
            held.append(unpacked_keys(keys))
            times.append(unpacked(counts))
    if held:
        yield from built(now)


def segment_filter(keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The words of one segment's filter, of BITS_PER_ENTRY bits for each entry."""
    bits = -(-max(1, int(levels.sum())) * BITS_PER_ENTRY // 64) * 64
    return build_segment(keys, levels, 1, bits)


BLOCKS_SQL = "block bigint, ids array<bigint>, held_out array<boolean>, sizes array<bigint>, words binary, places binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in blocks: their words' hashes, each once, and the place among these of every token."""
    block = TaskContext.get().partitionId() << 33
    held: list[tuple] = []

    def packed() -> pa.RecordBatch:
        ids, held_out, each = zip(*held)
        words, places, n = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
        # Frequent words first, so that the high bytes of places are mostly 0 and take little room.
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        planes = rank[places].view(np.uint8).reshape(-1, 4).T.tobytes()
        packer = zstandard.ZstdCompressor(level=1)
        values = [block, ids, held_out, [len(e) for e in each], words[order].tobytes(), packer.compress(planes)]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, types)], names=["block", "ids", "held_out", "sizes", "words", "places"]
        )

    size = 0
    for batch in batches:
        for own, held_out, text in zip(batch.column("id").to_pylist(), batch.column("held_out").to_pylist(), batch.column("text")):
            held.append((own, held_out, tokens(text.as_py())))
            size += len(held[-1][2])
            if size >= BLOCK:
                yield packed()
                held.clear()
                size = 0
                block += 1
    if held:
        yield packed()


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one at a time, as they are large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _tokens_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """A block's words, and their places."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["places"]), np.uint8)
    return np.frombuffer(row["words"], np.uint64), np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()


def _flat(row: dict, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, slice]]]:
    """A block's words, their places, and its n-grams' keys: of words first, each sorted; and the runs of a segment."""
    words, places = _tokens_of(row)
    keys = sorted_once(np.concatenate([words, [END], pairs(words[places])]))
    return words, places, keys, list(_runs(Filter.segment(keys, segments)))


ASKED_SQL = "segment bigint, block bigint, run bigint, packed binary, keys binary, counts binary"
ASKED = pa.schema([
    ("segment", pa.int64()), ("block", pa.int64()), ("run", pa.int64()), ("packed", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary()),
])


def _asked(batches: Iterator[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    """The keys of each block's n-grams by segment."""
    for batch in batches:
        for row in _each(batch):
            _, _, keys, runs = _flat(row, segments)
            yield from _rows(((of, row["block"], i, packed_keys(keys[at]), None, None) for i, (of, at) in enumerate(runs)), ASKED)


ANSWERED = pa.schema([("block", pa.int64()), ("run", pa.int64()), ("packed_levels", pa.binary()), ("counts", pa.binary())])


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Levels of the keys of each block and segment, and exact counts of words; a segment comes before the blocks that ask it.

    Blocks are answered together, as many as ask for PROBED keys, since a level costs the same for few keys as for many.
    """
    now, found_in, known, exact = None, None, np.empty(0, np.uint64), np.empty(0, np.uint64)
    held: list[tuple[int, int, np.ndarray]] = []

    def answers() -> Iterator[pa.RecordBatch]:
        keys = np.concatenate([asked for *_, asked in held])
        levels = found_in.levels(keys).astype(np.uint8) if found_in else np.zeros(len(keys), np.uint8)
        ends = np.cumsum([len(asked) for *_, asked in held])
        out = []
        for (block, run, asked), end in zip(held, ends.tolist()):
            times = np.zeros(0, np.int64)
            if len(asked) and asked[0] < PAIR:  # a run of words
                times = np.zeros(len(asked), np.int64)
                if len(known):
                    place = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                    times = np.where(known[place] == asked, exact[place], 0)
            packed_levels = zstandard.ZstdCompressor(level=1).compress(levels[end - len(asked) : end].tobytes())
            out.append((block, run, packed_levels, packed(times)))
        yield from _rows(out, ANSWERED)

    size = 0
    for batch in batches:
        for segment, block, run, data, keys, counts in zip(*[batch.column(n).to_pylist() for n in ASKED.names]):
            if held and (segment != now or size >= PROBED):
                yield from answers()
                held.clear()
                size = 0
            if segment != now:
                now, found_in, known, exact = segment, None, np.empty(0, np.uint64), np.empty(0, np.uint64)
            if block < 0:
                found_in = Filter(np.frombuffer(data, np.uint64)[None, :], 1)
                known, exact = unpacked_keys(keys), unpacked(counts)
                continue
            held.append((block, run, unpacked_keys(data)))
            size += len(held[-1][2])
    if held:
        yield from answers()


SCORED_SQL = "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _scored(batches: Iterator[pa.RecordBatch], total: int, distinct: int, weight: float, segments: int) -> Iterator[pa.RecordBatch]:
    """Scores of each text; a block comes before the answers to it."""
    spread = total + ADD * (distinct + 1)
    count_at = count_of(np.arange(MOST_LEVELS + 1))
    held: list[dict] = []

    def scores() -> Iterator[pa.RecordBatch]:
        block, *answers = held
        words, places, keys, runs = _flat(block, segments)
        levels, times = np.zeros(len(keys), np.uint8), np.zeros(np.searchsorted(keys, PAIR), np.int64)
        for answer in answers:
            _, at = runs[answer["run"]]
            levels[at] = np.frombuffer(zstandard.ZstdDecompressor().decompress(answer["packed_levels"]), np.uint8)
            if len(exact := unpacked(answer["counts"])):  # of words, with which the run begins
                times[at] = exact[: len(times) - at.start]
        of_word = np.searchsorted(keys, words)
        base_of = np.log10(times[of_word] + ADD) - np.log10(spread)
        known_of = (times[of_word] > 0).astype(np.int64)
        unigram_of = count_at[levels[of_word]]
        before = count_at[levels[np.searchsorted(keys, END)]]
        sizes = np.array(block["sizes"])
        ends = np.cumsum(sizes)
        first = 0
        while first < len(sizes):  # whole texts, of PIECE tokens if they are not longer
            begin = ends[first] - sizes[first]
            last = max(first + 1, int(np.searchsorted(ends, begin + PIECE, "right")))
            here, starts = places[begin : ends[last - 1]], ends[first:last] - sizes[first:last] - begin
            unigram = unigram_of[here]
            bigram = count_at[levels[np.searchsorted(keys, pairs(words[here]))]]
            context = np.concatenate([[before], unigram[:-1]])
            word = (unigram + ADD) / spread
            likely = (np.minimum(bigram, context) + weight * word) / (context + weight)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block["ids"][first:last], pa.int64()),
                    pa.array(block["held_out"][first:last], pa.bool_()),
                    pa.array(sizes[first:last], pa.int64()),
                    pa.array(np.add.reduceat(known_of[here], starts)),
                    pa.array(np.full(last - first, total, np.int64)),
                    pa.array(np.add.reduceat(base_of[here], starts)),
                    pa.array(np.add.reduceat(np.log10(likely), starts)),
                ],
                names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )
            first = last

    for batch in batches:
        for row in _each(batch):
            if row["run"] < 0 and held:
                yield from scores()
                held.clear()
            held.append(row)
    if held:
        yield from scores()


def _with_answers(blocks: DataFrame, built: DataFrame, segments: int) -> DataFrame:
    """Each of `blocks`, of run -1, and after it the levels and counts of each run of its n-grams."""
    filters = built.select(
        "segment", F.lit(-1).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("run"), F.col("words").alias("packed"), "keys", "counts"
    )
    asked = blocks.select("block", "words", "places").mapInArrow(partial(_asked, segments=segments), ASKED_SQL)
    answers = (
        filters.union(asked).repartition("segment").sortWithinPartitions("segment", "block")
        .mapInArrow(_answered, "block bigint, run bigint, packed_levels binary, counts binary")
    )
    return (
        blocks.withColumn("run", F.lit(-1).cast("bigint")).unionByName(answers, allowMissingColumns=True)
        .repartition("block").sortWithinPartitions("block", "run")
    )


def scored(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_bytes: int = SEGMENT_BYTES,
    weight: float = WEIGHT,
) -> DataFrame:
    """Rows (id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs`.

    A tenth of the documents, by the CRC-32 of the identifier, is held out from training.
    """
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 10 == 0).alias("held_out"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    kept = stored(texts.mapInArrow(_blocks, BLOCKS_SQL), "blocks", BATCH)
    blocks = kept.df
    trained = F.filter(F.arrays_zip("held_out", "sizes"), lambda d: ~d["held_out"])
    size = blocks.agg(F.sum(F.aggregate(trained, F.lit(0).cast("bigint"), lambda a, d: a + d["sizes"]))).first()[0] or 0
    segments = 1 + size * TOKEN_BYTES // segment_bytes
    counted = blocks.select("held_out", "sizes", "words", "places").mapInArrow(partial(_counted, segments=segments), COUNTED_SQL)
    built = stored(counted.repartition("segment").sortWithinPartitions("segment").mapInArrow(_built, BUILT_SQL), "segments", BATCH)
    total, distinct = built.df.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    # Written, so that the workers get small batches, and nothing but the scores is left on disk.
    rows = stored(
        _with_answers(blocks, built.df, segments).mapInArrow(
            partial(_scored, total=total, distinct=distinct, weight=weight, segments=segments), SCORED_SQL
        ),
        "scores", BATCH,
    ).df
    discard(docs.sparkSession, kept, built)
    return rows
