"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked id pairs.

Tokenizer A is a byte-level BPE, B a BPE of pieces with byte fallback. Both see a blank and the text. Where a token of A
and a token of B end at the same byte, a group ends; a link is a pair of tokens that overlap.

Texts are cut before white space, where neither tokenizer can join: A splits there before it merges, and no piece of B
holds a blank after another character (read from the vocabulary; a carriage return is the exception here). What lies
between two cuts is encoded once a task. Of a block of texts every distinct stretch is aligned once and the links of the
block are counted by pair; the corpus-wide counts are sums over blocks and come back to each block's pairs by a join, so
no table of pairs has to fit anywhere.

Very long texts are dealt out as byte ranges. A range's task encodes from the cut before the range to the cut after it and
keeps the tokens that start inside: up to the first place where tokens of both start they are an open prefix, then come
closed groups, and from the last such place on an open suffix. Such fragments form a monoid: joining two closes the group
between them, if both have a place to close it, and otherwise lengthens an open end. Neighbours are joined by a tree of
bounded steps, whatever the length, and the closed runs of groups are counted like texts. Only a stretch without any cut
is encoded by one task, however long.

Texts that are null or empty have no tokens, nor do those which one of the tokenizers does not give back byte for byte;
they count nowhere. A long text that repeats is aligned once and counted as often as it occurs. Repeated rows are rows of
their own, a null identifier is kept, an empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import discard, stored

BLOCK_BYTES = 1 << 22
LONG_BYTES = 1 << 16
CHUNK_BYTES = 1 << 15
FAN = 16  # fragments joined in one step
MOST_STRETCHES = 150_000  # kept for the next time, then begun anew

LEARNT = 20_000  # stretches encoded at a time, which bounds the lists of their ids

# Unicode's white space, as the pattern of tokenizer A has it, and that pattern.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_STRETCH = 100_000  # characters; longer ones are left to the tokenizer's own library
PIECE_BLANK = "▁"


def _bytes_of_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A. Special tokens are plain text."""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        model, before = known["model"], known.get("pre_tokenizer") or {}
        of = _bytes_of_characters()
        added = {t["content"]: t["id"] for t in known.get("added_tokens", [])}
        names = {i: t.encode() if t in added else bytes(of[c] for c in t) for t, i in (model["vocab"] | added).items()}
        self.bytes = [names.get(i, b"") for i in range(max(names) + 1)]
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        self.fast = None
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        # With merges in the order of their ids the same vocabulary as ranks gives the same ids, several times faster.
        if plain and known.get("normalizer") is None and merged == sorted(merged):
            import tiktoken

            ranks = {names[i]: i for t, i in model["vocab"].items() if t not in added}
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def own(self):
        """The tokenizer of the file itself."""
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def encode(self, text: str) -> list[int]:
        if self.fast is None or len(text) > LONG_STRETCH:
            return self.own.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [self.encode(t) for t in texts]


class Pieces:
    """Tokenizer B, which puts a blank before what it is given."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes, self.joined = [], set()
        for i in range(self.own.get_piece_size()):
            piece = self.own.id_to_piece(i)
            if self.own.is_byte(i):
                self.bytes.append(bytes([int(piece[3:-1], 16)]))
                continue
            self.bytes.append(piece.replace(PIECE_BLANK, " ").encode())
            if not self.own.is_control(i) and not self.own.is_unknown(i):
                plain = piece.replace(PIECE_BLANK, " ")
                self.joined |= {b for a, b in itertools.pairwise(plain) if a not in BLANKS and b in BLANKS}
        self.start = self.own.encode("\n")  # a blank and a line break, which no piece joins to what follows
        if any("\n" in self.own.id_to_piece(i) for i in range(self.own.get_piece_size())):
            raise ValueError("a vocabulary with line breaks in its pieces is not supported")

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts as they are: the blank that is put before them is theirs, or is taken off with a line break."""
        own = [t[1:] if t[0] == " " and len(t) > 1 else "\n" + t for t in texts]
        found = self.own.encode(own, num_threads=1)
        return [ids if t[0] == " " and len(t) > 1 else ids[len(self.start) :] for t, ids in zip(texts, found)]


def stretch_pattern(joined: set[str]) -> re.Pattern:
    """Stretches between cuts. A cut lies before white space after another character, unless that space is `joined`."""
    every = f"[{re.escape(BLANKS)}]"
    other = f"[^{re.escape(BLANKS)}]"
    on = f"(?:[{re.escape(''.join(sorted(joined)))}]{every}*{other}*)*" if joined else ""
    return re.compile(f"{every}*{other}+{on}|{every}+")


def _flat(ids: Iterable[list[int]]) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int64)


def _counts(ids: list) -> np.ndarray:
    return np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of `counts` values."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]


class Pair:
    """Both tokenizers, with what alignment needs to know of their ids."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.pattern = stretch_pattern(self.b.joined)
        self.sizes_a, self.sizes_b = _counts(self.a.bytes), _counts(self.b.bytes)
        self.names_a = {end: [b"%d%s" % (i, end) for i in range(len(self.a.bytes))] for end in (b",", b"|")}
        self.names_b = {end: [b"%d%s" % (i, end) for i in range(len(self.b.bytes))] for end in (b",", b";")}
        self.names_a = {k: np.array(v, dtype=object) for k, v in self.names_a.items()}
        self.names_b = {k: np.array(v, dtype=object) for k, v in self.names_b.items()}

    def encoded(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of A, ids of B, and whether both give the text back; without ids where they do not."""
        a, b = self.a.encode_all(texts), self.b.encode_all(texts)
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        good = np.ones(len(texts), dtype=bool)
        whole = b"".join(raw)
        for ids, names in ((a, self.a.bytes), (b, self.b.bytes)):
            same_sizes = _counts(raw) == _sums(_counts(names)[_flat(ids)], _counts(ids))
            if same_sizes.all() and b"".join([names[i] for x in ids for i in x]) == whole:
                continue
            good &= [b"".join([names[i] for i in x]) == r for x, r in zip(ids, raw)]
        for i in np.flatnonzero(~good).tolist():
            a[i], b[i] = [], []
        return a, b, good

    def aligned(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> tuple:
        """Of runs of tokens with the same bytes: groups and links of each run, the pair of each link, groups as text."""
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        run_ends = np.concatenate([[0], ends_a])[np.cumsum(n_a)]
        # Between two neighbouring ends lies the overlap of exactly one token of A and one of B.
        ends = np.union1d(ends_a, ends_b)
        pairs = (a[np.searchsorted(ends_a, ends)] << 32) | b[np.searchsorted(ends_b, ends)]
        links = np.diff(np.searchsorted(ends, run_ends, side="right"), prepend=0)
        closed = np.intersect1d(ends_a, ends_b, assume_unique=True)
        groups = np.diff(np.searchsorted(closed, run_ends, side="right"), prepend=0)
        in_a, in_b = np.searchsorted(closed, ends_a), np.searchsorted(closed, ends_b)
        names = np.concatenate([
            np.where(closed[in_a] == ends_a, self.names_a[b"|"][a], self.names_a[b","][a]),
            np.where(closed[in_b] == ends_b, self.names_b[b";"][b], self.names_b[b","][b]),
        ])[np.argsort(np.concatenate([2 * in_a, 2 * in_b + 1]), kind="stable")].tolist()
        upto = np.cumsum(n_a + n_b).tolist()
        texts = [b"".join(names[s:e]) for s, e in zip([0, *upto[:-1]], upto)]
        return groups, links, pairs, texts


class Stretches:
    """Alignments of the stretches met so far."""

    def __init__(self, pair: Pair) -> None:
        self.pair = pair
        self.begin()

    def begin(self) -> None:
        self.place: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.pairs = np.empty(0, dtype=np.int64)
        self.numbers = np.empty((0, 5), dtype=np.int64)  # tokens of A, of B, groups, links, 1 if given back
        self.first = np.zeros(1, dtype=np.int64)  # of each stretch's pairs

    def learn(self, new: list[str]) -> None:
        a, b, good = self.pair.encoded(new)
        n_a, n_b = _counts(a), _counts(b)
        groups, links, pairs, texts = self.pair.aligned(_flat(a), n_a, _flat(b), n_b)
        self.place.update(zip(new, itertools.count(len(self.place))))
        self.texts += texts
        self.pairs = np.concatenate([self.pairs, pairs])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(links)])
        self.numbers = np.concatenate([self.numbers, np.stack([n_a, n_b, groups, links, good.astype(np.int64)], axis=1)])

    def places(self, stretches: list[str]) -> np.ndarray:
        if len(self.place) > MOST_STRETCHES:
            self.begin()
        found = list(map(self.place.get, stretches))
        if None in found:
            for some in itertools.batched({s for s, i in zip(stretches, found) if i is None}, LEARNT):
                self.learn(list(some))
            found = list(map(self.place.__getitem__, stretches))
        return np.array(found, dtype=np.int64)


Finish = Callable[[Iterable[bytes]], object]
"""From a text's groups, in parts, to what is kept of them."""


def as_bytes(groups: Iterable[bytes]) -> bytes:
    """`a1,a2|b1;a3|b2,b3`: ids of A and B in order, group by group."""
    return b"".join(groups)


def _packed(numbers: np.ndarray) -> bytes:
    """Small numbers below 2 ** 32, plane by plane."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
BLOCK = [("block", "bigint", pa.int64()), ("ids", "array<bigint>", pa.list_(pa.int64())), ("keys", "array<string>", pa.list_(pa.string()))]
BLOCK += [(n, "array<bigint>", pa.list_(pa.int64())) for n in [*NUMBERS, "n_stretches"]]
BLOCK += [("stretches", "binary", pa.binary()), ("links", "binary", pa.binary()), ("places", "binary", pa.binary())]
BLOCK += [("pairs", "array<bigint>", pa.list_(pa.int64())), ("times", "array<bigint>", pa.list_(pa.int64()))]


def _schema(columns: list, kind: tuple[str, pa.DataType] | None = None) -> tuple[str, pa.Schema]:
    if kind:
        columns = [*columns, ("groups", f"array<{kind[0]}>", pa.list_(kind[1]))]
    return ", ".join(f"{n} {s}" for n, s, _ in columns), pa.schema([(n, t) for n, _, t in columns])


def _block(number: int, ids: list, keys: list, numbers: np.ndarray, n_stretches: np.ndarray, used: np.ndarray, copies: np.ndarray,
           links: np.ndarray, pairs_of: Callable[[np.ndarray], np.ndarray]) -> dict:
    """A row of a block. `used`: stretches in order, `copies`: how often each of them counts, `links`: of every stretch known."""
    local, places = np.unique(used, return_inverse=True)
    # Common stretches get small numbers, which pack well.
    order = np.argsort(-np.bincount(places, minlength=len(local)), kind="stable")
    rank = np.empty(len(local), dtype=np.int64)
    rank[order] = np.arange(len(local))
    local, places = local[order], rank[places]
    counts = np.bincount(places, weights=copies, minlength=len(local)).astype(np.int64)
    pairs, of_pair = np.unique(pairs_of(local), return_inverse=True)
    times = np.bincount(of_pair, weights=np.repeat(counts, links[local]), minlength=len(pairs)).astype(np.int64)
    row = {"block": number, "ids": ids, "keys": keys, "n_stretches": n_stretches, "stretches": _packed(places)}
    row |= {n: numbers[:, k] for k, n in enumerate(NUMBERS)}
    return row | {"links": _packed(links[local]), "places": _packed(of_pair), "pairs": pairs, "times": times}


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... `counts[0]` of them, and so on."""
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(starts - before, counts)


def _texts_to_blocks(
    batches: Iterator[pa.RecordBatch], paths: tuple[str, str], most: int, finish: Finish, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) to blocks."""
    known: list[Stretches] = []
    numbered = itertools.count(TaskContext.get().partitionId() << 32)

    def made(ids: list, texts: list) -> pa.RecordBatch:
        if not known:
            known.append(Stretches(Pair(*paths)))
        own = known[0]
        split = [own.pair.pattern.findall(" " + t) if t else [] for t in texts]
        counts = _counts(split)
        used = own.places(list(itertools.chain.from_iterable(split)))
        good = _sums(1 - own.numbers[used, 4], counts) == 0
        used, counts = used[np.repeat(good, counts)], np.where(good, counts, 0)
        ends = np.cumsum(counts).tolist()
        names = [own.texts[i] for i in used.tolist()]
        groups = [finish(_trimmed(names[s:e])) if s < e else None for s, e in zip([0, *ends[:-1]], ends)]
        numbers = np.stack([_sums(own.numbers[used, k], counts) for k in range(4)], axis=1)
        links = own.numbers[:, 3]
        row = _block(
            next(numbered), ids, [None] * len(ids), numbers, counts, used, np.ones(len(used)), links,
            lambda local: own.pairs[_ranges(own.first[local], links[local])],
        )
        return _record(row | {"groups": groups}, schema)

    ids, texts, size = [], [], 0
    for batch in batches:
        for one, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(one)
            texts.append(text)
            size += len(text or "") + 1
            if size >= most:
                yield made(ids, texts)
                ids, texts, size = [], [], 0
    if ids:
        yield made(ids, texts)


def _record(row: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)


def _trimmed(parts: list[bytes]) -> list[bytes]:
    """Without the semicolon after the last group."""
    return [*parts[:-1], parts[-1][:-1]]


# Long texts: byte ranges, fragments, runs of closed groups.

CHUNKS_SQL = "key string, chunk bigint, low bigint, high bigint, base bigint, text string"
CHUNKS = pa.schema([
    ("key", pa.string()), ("chunk", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("base", pa.int64()), ("text", pa.string()),
])


def ranges_of(cuts: np.ndarray, chunk_bytes: int) -> list[tuple[int, int]]:
    """Byte ranges of a text with these cuts (its beginning and end among them).

    Ranges end at multiples of `chunk_bytes`, wherever tokens lie; but a stretch longer than a range is a range of its own.
    """
    size = int(cuts[-1])
    marks = np.arange(chunk_bytes, size, chunk_bytes)
    upper = np.searchsorted(cuts, marks, side="left")  # marks lie in (cuts[upper - 1], cuts[upper]]
    solid = cuts[upper] - cuts[upper - 1] > chunk_bytes
    edges = np.unique(np.concatenate([[0, size], marks[~solid], cuts[upper[solid]], cuts[upper[solid] - 1]]))
    return list(itertools.pairwise(edges.tolist()))


def _chunks(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    pattern = None
    for batch in batches:
        pattern = pattern or stretch_pattern(Pieces(paths[1]).joined)
        for key, text in zip(*[c.to_pylist() for c in batch.columns]):
            raw = (" " + text).encode()
            sizes = [len(m.encode()) for m in pattern.findall(" " + text)]
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            del sizes
            for number, (low, high) in enumerate(ranges_of(cuts, chunk_bytes)):
                base = int(cuts[np.searchsorted(cuts, low, side="right") - 1])
                end = int(cuts[np.searchsorted(cuts, high, side="left")])
                row = {"key": key, "chunk": number, "low": low, "high": high, "base": base, "text": raw[base:end].decode()}
                yield pa.RecordBatch.from_pylist([row], schema=CHUNKS)


FRAGMENT = [("key", "string", pa.string()), ("chunk", "bigint", pa.int64()), ("run", "bigint", pa.int64()), ("good", "boolean", pa.bool_()),
            ("cut", "boolean", pa.bool_()), ("at", "bigint", pa.int64())]
FRAGMENT += [(n, "binary", pa.binary()) for n in ("first_a", "first_b", "last_a", "last_b")]
FRAGMENT_SQL, FRAGMENT_SCHEMA = _schema(FRAGMENT)
"""A fragment (run is null) or a run of closed groups (in first_a, first_b).

`cut`: whether the fragment has a place where tokens of both start; `at`: the chunk of the last such place. Runs are
numbered in order: twice the chunk for those within it, one more for the group that begins there and ends later.
"""


def _ids(array: np.ndarray) -> bytes:
    return array.astype("<u4").tobytes()


def _run(key: str, number: int, a: bytes, b: bytes) -> dict:
    return {"key": key, "run": number, "good": True, "first_a": a, "first_b": b}


def fragment(pair: Pair, key: str, chunk: int, low: int, high: int, base: int, text: str) -> list[dict]:
    """The fragment of a byte range, and the groups that are closed in it."""
    a, b, good = pair.encoded([text])
    own = {"key": key, "chunk": chunk, "good": bool(good[0]), "cut": False, "at": chunk}
    a, b = _flat(a), _flat(b)
    starts_a = base + np.cumsum(pair.sizes_a[a]) - pair.sizes_a[a]
    starts_b = base + np.cumsum(pair.sizes_b[b]) - pair.sizes_b[b]
    inside_a, inside_b = (starts_a >= low) & (starts_a < high), (starts_b >= low) & (starts_b < high)
    a, b, starts_a, starts_b = a[inside_a], b[inside_b], starts_a[inside_a], starts_b[inside_b]
    both = np.intersect1d(starts_a, starts_b, assume_unique=True)
    if not len(both):
        return [own | {"first_a": _ids(a), "first_b": _ids(b), "last_a": b"", "last_b": b""}]
    begin_a, end_a = np.searchsorted(starts_a, both[[0, -1]])
    begin_b, end_b = np.searchsorted(starts_b, both[[0, -1]])
    rows = [own | {
        "cut": True, "first_a": _ids(a[:begin_a]), "first_b": _ids(b[:begin_b]), "last_a": _ids(a[end_a:]), "last_b": _ids(b[end_b:]),
    }]
    if len(both) > 1:
        rows.append(_run(key, 2 * chunk, _ids(a[begin_a:end_a]), _ids(b[begin_b:end_b])))
    return rows


def joined(left: dict, right: dict) -> tuple[dict, dict | None]:
    """The fragment of both ranges, and the run that the join closes."""
    out = left | {"good": left["good"] and right["good"]}
    a, b = left["last_a"] + right["first_a"], left["last_b"] + right["first_b"]
    if not left["cut"]:
        return out | {
            "first_a": left["first_a"] + right["first_a"], "first_b": left["first_b"] + right["first_b"],
            "cut": right["cut"], "at": right["at"], "last_a": right["last_a"], "last_b": right["last_b"],
        }, None
    if not right["cut"]:
        return out | {"last_a": a, "last_b": b}, None
    closed = _run(left["key"], 2 * left["at"] + 1, a, b) if a else None
    return out | {"at": right["at"], "last_a": right["last_a"], "last_b": right["last_b"]}, closed


def _fragments(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    pair = None
    for batch in batches:
        pair = pair or Pair(*paths)
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield pa.RecordBatch.from_pylist(fragment(pair, **row), schema=FRAGMENT_SCHEMA)


def _join_step(fan: int) -> Callable[[pa.Table], pa.Table]:
    """Neighbouring fragments of a text, `fan` at most, to one."""
    def step(table: pa.Table) -> pa.Table:
        whole, *others = table.sort_by("chunk").to_pylist()
        runs = []
        for other in others:
            whole, closed = joined(whole, other)
            runs += [closed] if closed else []
        return pa.Table.from_pylist([whole | {"chunk": whole["chunk"] // fan}, *runs], schema=FRAGMENT_SCHEMA)

    return step


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last group of each whole text."""
    for batch in batches:
        rows = [_run(r["key"], 2 * r["at"] + 1, r["last_a"], r["last_b"]) for r in batch.to_pylist()]
        yield pa.RecordBatch.from_pylist(rows, schema=FRAGMENT_SCHEMA)


def closed_runs(texts: DataFrame, paths: tuple[str, str], chunk_bytes: int, fan: int) -> DataFrame:
    """Rows (key, run, a, b) of the runs of closed groups of texts (key, text), without texts that are not given back."""
    spark = texts.sparkSession
    chunks = texts.select("key", "text").mapInArrow(functools.partial(_chunks, paths=paths, chunk_bytes=chunk_bytes), CHUNKS_SQL)
    found = stored(
        chunks.repartition("key", "chunk").mapInArrow(functools.partial(_fragments, paths=paths), FRAGMENT_SQL), "fragments"
    ).df
    runs = [found.where("run is not null")]
    open_ = found.where("run is null")
    last = open_.agg(F.max("chunk")).first()[0]
    while last:
        by = [F.col("key"), F.floor(F.col("chunk") / fan).alias("step")]
        step = stored(open_.groupBy(*by).applyInArrow(_join_step(fan), FRAGMENT_SQL), "fragments").df
        runs.append(step.where("run is not null"))
        open_ = step.where("run is null")
        last //= fan
    runs.append(open_.mapInArrow(_close, FRAGMENT_SQL))
    good = open_.where("good").select("key")
    every = functools.reduce(DataFrame.union, runs).select("key", "run", F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    return stored(every.join(good, "key", "left_semi"), "runs").df


def _run_arrays(rows: list[dict]) -> tuple:
    a, b = ([np.frombuffer(r[c], "<u4").astype(np.int64) for r in rows] for c in "ab")
    none = [np.empty(0, dtype=np.int64)]
    return np.concatenate(a + none), _counts(a), np.concatenate(b + none), _counts(b)


def _runs_to_blocks(
    batches: Iterator[pa.RecordBatch], paths: tuple[str, str], most: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Rows (key, run, a, b, copies) to blocks, in which every run is a stretch."""
    pair = None
    numbered = itertools.count(TaskContext.get().partitionId() << 32)
    for rows in _by_bytes(batches, most):
        pair = pair or Pair(*paths)
        a, n_a, b, n_b = _run_arrays(rows)
        groups, links, pairs, _ = pair.aligned(a, n_a, b, n_b)
        n, first = len(rows), np.cumsum(links) - links
        row = _block(
            -1 - next(numbered), [None] * n, [r["key"] for r in rows], np.stack([n_a, n_b, groups, links], axis=1), np.ones(n), np.arange(n),
            np.array([r["copies"] for r in rows]), links, lambda local: pairs[_ranges(first[local], links[local])],  # noqa: B023
        )
        yield _record(row | {"groups": [None] * n}, schema)


def _by_bytes(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[dict]]:
    held, size = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            held.append(row)
            size += len(row["a"]) + len(row["b"])
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def _finish_runs(
    batches: Iterator[pa.RecordBatch], paths: tuple[str, str], most: int, finish: Finish, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Rows (key, run, a, b) in order to what `finish` makes of each text's groups, read run by run."""
    pair = Pair(*paths)

    def parts() -> Iterator[tuple[str, bytes]]:
        for rows in _by_bytes(batches, most):
            yield from zip([r["key"] for r in rows], pair.aligned(*_run_arrays(rows))[3])

    def trimmed(own: Iterator[tuple[str, bytes]]) -> Iterator[bytes]:
        _, before = next(own)
        for _, part in own:
            yield before
            before = part
        yield before[:-1]

    for key, own in itertools.groupby(parts(), key=lambda p: p[0]):
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([finish(trimmed(own))], schema.field(1).type)], schema=schema)


# All blocks: counts of pairs over the corpus, and back.

SCORED = [("id", "bigint", pa.int64()), ("key", "string", pa.string()), *[(n, "bigint", pa.int64()) for n in [*NUMBERS, "n_best", "count_sum"]]]


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Rows (pair, n, best): how many links hold a pair, and whether no pair of its id of B has more."""
    asked = blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counts = asked.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF))  # a row for each id of A at most
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_b)).alias("best"))


def _score(schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Sums over each entry of a block, from the answers (pos, n, best) to its pairs."""
    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        counts, best = np.zeros(answers.num_rows, np.int64), np.zeros(answers.num_rows, np.int64)
        pos = answers.column("pos").to_numpy()
        counts[pos], best[pos] = answers.column("n").to_numpy(), answers.column("best").to_numpy().astype(np.int64)
        n_stretches = np.array(row["n_stretches"], dtype=np.int64)
        stretches = _unpacked(row["stretches"], int(n_stretches.sum()))
        links = _unpacked(row["links"], int(stretches.max(initial=-1)) + 1)
        places = _unpacked(row["places"], int(links.sum()))
        sums = [_sums(_sums(x[places], links)[stretches], n_stretches) for x in (best, counts)]
        columns = {
            "id": row["ids"], "key": row["keys"], **{n: row[n] for n in NUMBERS}, "n_best": sums[0], "count_sum": sums[1],
            "groups": row["groups"],
        }
        return pa.Table.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

    return score


def aligned(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    finish: Finish = as_bytes,
    kind: tuple[str, pa.DataType] = ("binary", pa.binary()),
    block_bytes: int = BLOCK_BYTES,
    long_bytes: int = LONG_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    fan: int = FAN,
) -> DataFrame:
    """Rows (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row of `docs`.

    `groups` is what `finish` makes of the aligned groups, of the type `kind` in Spark and in Arrow; null without tokens.
    The paths are those of the tokenizers' files on every executor.
    """
    paths = (path_a, path_b)
    block_sql, block_schema = _schema(BLOCK, kind)
    scored_schema = pa.schema([*[(n, t) for n, _, t in SCORED], ("groups", kind[1])])
    scored_sql = ", ".join([*[f"{n} {s}" for n, s, _ in SCORED], f"groups {kind[0]}"])
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.octet_length("text"), F.lit(0)) > long_bytes
    blocks = texts.where(~is_long).mapInArrow(
        functools.partial(_texts_to_blocks, paths=paths, most=block_bytes, finish=finish, schema=block_schema), block_sql
    )
    keyed = texts.where(is_long).select("id", F.sha2("text", 256).alias("key"), "text")
    once = stored(keyed.groupBy("key").agg(F.count("*").alias("copies"), F.first("text").alias("text")), "long").df
    runs = closed_runs(once, paths, chunk_bytes, fan)
    long_blocks = runs.join(once.select("key", "copies"), "key").mapInArrow(
        functools.partial(_runs_to_blocks, paths=paths, most=block_bytes, schema=block_schema), block_sql
    )
    all_blocks = stored(blocks.union(long_blocks), "blocks").df
    counts = stored(pair_counts(all_blocks), "pairs").df

    asked = all_blocks.select(F.col("block").alias("of"), F.posexplode("pairs").alias("pos", "pair"))
    answers = asked.join(counts, "pair").select("of", "pos", "n", "best")
    payload = all_blocks.drop("pairs", "times")
    scored = payload.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(
        _score(scored_schema), scored_sql
    )
    scored = stored(scored, "scored").df

    numbers = [n for n, _, _ in SCORED[2:]]
    finished = runs.repartition("key").sortWithinPartitions("key", "run").mapInArrow(
        functools.partial(_finish_runs, paths=paths, most=block_bytes, finish=finish, schema=pa.schema([("key", pa.string()), ("groups", kind[1])])),
        f"key string, groups {kind[0]}",
    )
    of_long = scored.where("key is not null").groupBy("key").agg(*[F.sum(n).alias(n) for n in numbers])
    long_rows = keyed.select("id", "key").join(of_long.join(finished, "key"), "key", "left").select(
        "id", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers], "groups"
    )
    return scored.where("key is null").select("id", *numbers, "groups").union(long_rows)
