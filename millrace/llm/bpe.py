"""BPE encoding and decoding with a given tokenizer, by tree concatenation for long texts.

Short texts are encoded word by word: the tokenizers meant here never join what white space separates, so a text's ids
are those of its words, and a word's ids are kept for the next time it is met. Long texts are cut in halves, and the
halves again, into pieces that different tasks encode as a whole. Neighbouring pieces are then joined, pair by pair and
pairs of pairs: a window around the join is encoded anew and grows until it has tokens in common with both sides, at
the same places and with the same ids; from there on either side stands. Joining costs a few windows whatever the
length.

Null texts count as empty and have no ids. Texts that look like special tokens are encoded as the tokenizer encodes
them. A long text that repeats is encoded once, a short one each time.
"""

from __future__ import annotations

import functools
import itertools
import os
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_CHARS = 1 << 16
WINDOW_CHARS = 64
SAME_TOKENS = 4  # in a row, for two encodings to agree
MOST_WORDS = 150_000  # kept for the next time, then begun anew
TEXTS = 200  # encoded at a time


def load(path: str):
    """The tokenizer without truncation and padding, in this thread only; Spark runs the tasks side by side."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Words:
    """Ids of words (in UTF-8) as bytes, worked out when first asked for."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.known = tokenizer, {}

    def learn(self, words: list[bytes]) -> None:
        if len(self.known) > MOST_WORDS:
            self.known = {}
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        self.known.update((w, array("I", f.ids).tobytes()) for w, f in zip(words, found))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        split = [text.encode().split() for text in texts]  # bytes are split at ASCII white space only
        flat = list(itertools.chain.from_iterable(split))
        ids = list(map(self.known.get, flat))
        if None in ids:
            self.learn(list({w for w, i in zip(flat, ids) if i is None}))
            ids = [self.known[w] if i is None else i for w, i in zip(flat, ids)]
        ends = list(itertools.accumulate(map(len, split), initial=0))
        return [np.frombuffer(b"".join(ids[s:e]), dtype=np.uint32) for s, e in itertools.pairwise(ends)]


class Piece:
    """A stretch of a text with its tokens as rows (id, first character, end), all places within the whole text."""

    def __init__(self, start: int, text: str, tokens: np.ndarray) -> None:
        self.start, self.text, self.tokens = start, text, tokens

    @property
    def end(self) -> int:
        return self.start + len(self.text)


def encode_piece(tokenizer, text: str, start: int) -> Piece:
    found = tokenizer.encode(text, add_special_tokens=False)
    tokens = np.empty((len(found.ids), 3), dtype=np.int64)
    if len(found.ids):
        tokens[:, 0] = found.ids
        tokens[:, 1:] = found.offsets
        tokens[:, 1:] += start
    return Piece(start, text, tokens)


def _meet(a: np.ndarray, b: np.ndarray) -> tuple[int, int] | None:
    """The first places in `a` and `b` from which SAME_TOKENS tokens in a row are the same."""
    places: dict[tuple, list[int]] = {}
    for j, token in enumerate(map(tuple, b)):
        places.setdefault(token, []).append(j)
    for i in range(len(a) - SAME_TOKENS + 1):
        for j in places.get(tuple(a[i]), ()):
            if np.array_equal(a[i : i + SAME_TOKENS], b[j : j + SAME_TOKENS]) and len(b) - j >= SAME_TOKENS:
                return i, j
    return None


def splits_cleanly(text: str, at: int) -> bool:
    """Whether normalising the parts gives the same as normalising the whole, around a cut."""
    near = slice(max(0, at - 16), at + 16)
    left, right = text[near.start : at], text[at : near.stop]
    return unicodedata.normalize("NFC", left) + unicodedata.normalize("NFC", right) == unicodedata.normalize("NFC", left + right)


def join(tokenizer, left: Piece, right: Piece) -> Piece:
    """The encoding of both stretches together, from windows around the place where they meet."""
    text = left.text + right.text
    whole = Piece(left.start, text, np.empty((0, 3), dtype=np.int64))
    width = WINDOW_CHARS
    while True:
        low, high = max(left.start, right.start - width), min(right.end, right.start + width)
        while low > left.start and not splits_cleanly(text, low - left.start):
            low -= 1
        while high < right.end and not splits_cleanly(text, high - left.start):
            high += 1
        window = encode_piece(tokenizer, text[low - left.start : high - left.start], low).tokens
        inside = window[:, 2] <= right.start
        before = left.tokens[np.searchsorted(left.tokens[:, 1], low) :]
        after = right.tokens[: np.searchsorted(right.tokens[:, 1], high)]
        first = (len(left.tokens) - len(before), 0) if low == left.start else None
        if first is None:
            met = _meet(before, window[inside])
            first = met and (len(left.tokens) - len(before) + met[0], met[1])
        last = (len(after), len(window)) if high == right.end else None
        if last is None:
            begun = len(window) - int(np.count_nonzero(window[:, 1] >= right.start))
            met = _meet(after, window[begun:])
            last = met and (met[0], met[1] + begun)
        if low == left.start:
            first = (0, 0)
        if high == right.end:
            last = (len(right.tokens), len(window))
        if first and last:
            whole.tokens = np.concatenate([left.tokens[: first[0]], window[first[1] : last[1]], right.tokens[last[0] :]])
            return whole
        width *= 2


def halves(text: str, most: int) -> list[tuple[int, str]]:
    """The text cut in the middle until no piece is longer than `most`."""
    if len(text) <= most:
        return [(0, text)]
    middle = len(text) // 2
    return halves(text[:middle], most) + [(s + middle, t) for s, t in halves(text[middle:], most)]


def join_all(tokenizer, pieces: list[Piece]) -> Piece:
    """Join neighbours, level by level."""
    while len(pieces) > 1:
        pairs = [pieces[i : i + 2] for i in range(0, len(pieces), 2)]
        pieces = [join(tokenizer, *p) if len(p) == 2 else p[0] for p in pairs]
    return pieces[0]


Finish = Callable[[object, list[np.ndarray]], list[list]]
"""From the tokenizer and the ids of some texts to columns."""


def as_ids(tokenizer, ids: list[np.ndarray]) -> list[list]:
    return [ids]


NAMES: dict[int, np.ndarray] = {}
"""Of the tokenizer in use, by its identity."""


def decode(tokenizer, ids: list[np.ndarray]) -> list[str]:
    """What the tokenizer decodes ids to. One without a decoder puts blanks between its tokens."""
    if tokenizer.decoder is not None:
        return tokenizer.decode_batch([i.tolist() for i in ids], skip_special_tokens=False)
    if id(tokenizer) not in NAMES:
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        names = np.empty(max(vocabulary.values()) + 1, dtype=object)
        names[list(vocabulary.values())] = list(vocabulary)
        NAMES.clear()
        NAMES[id(tokenizer)] = names
    return [" ".join(NAMES[id(tokenizer)][i].tolist()) for i in ids]


def _short(batches: Iterator[pa.RecordBatch], path: str, finish: Finish, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    tokenizer = load(path)
    words = Words(tokenizer)
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            part = batch.slice(at, TEXTS)
            columns = finish(tokenizer, words.ids(part.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]], schema=schema
            )


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows (row, piece, start, text) of the pieces."""
    for batch in batches:
        for row, text in zip(*[c.to_pylist() for c in batch.columns]):
            cut = halves(text, most)
            yield pa.RecordBatch.from_pydict({
                "row": [row] * len(cut),
                "piece": pa.array(range(len(cut)), pa.int32()),
                "start": pa.array([s for s, _ in cut], pa.int64()),
                "text": [t for _, t in cut],
            })


PIECES_SQL = "row string, piece int, start bigint, text string"
ENCODED_SQL = PIECES_SQL + ", tokens binary"


def _encode_pieces(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokenizer = load(path)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            piece = encode_piece(tokenizer, row.column("text")[0].as_py(), row.column("start")[0].as_py())
            yield pa.RecordBatch.from_arrays(
                [*row.columns, pa.array([piece.tokens.tobytes()], pa.binary())], names=[*row.schema.names, "tokens"]
            )


def _join_row(table: pa.Table, tokenizer, finish: Finish, schema: pa.Schema) -> pa.Table:
    """The row of a text from its pieces."""
    rows = table.sort_by("piece").to_pylist()
    pieces = [Piece(r["start"], r["text"], np.frombuffer(r["tokens"], dtype=np.int64).reshape(-1, 3)) for r in rows]
    ids = join_all(tokenizer, pieces).tokens[:, 0].astype("<u4")
    values = [[rows[0]["row"]], *finish(tokenizer, [ids])]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(values, schema)], schema=schema)


def encoded(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    finish: Finish = as_ids,
    columns: dict[str, tuple[str, pa.DataType]] | None = None,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """Rows (id, ids) of every row of `docs`; or (id, and what `finish` makes of the ids).

    `columns` names those of `finish`, with their types in Spark and in Arrow. `path` is the tokenizer's file on every
    executor.
    """
    columns = columns or {"ids": ("array<bigint>", pa.list_(pa.int64()))}
    schema = pa.schema([("id", pa.int64()), *[(n, t) for n, (_, t) in columns.items()]])
    sql = ", ".join(["id bigint", *[f"{n} {t}" for n, (t, _) in columns.items()]])

    joined_schema = pa.schema([("row", pa.string()), *list(schema)[1:]])
    joined_sql = ", ".join(["row string", *[f"{n} {t}" for n, (t, _) in columns.items()]])
    held: list = []  # a task's tokenizer, loaded once for all its texts

    def joined(table: pa.Table) -> pa.Table:
        if not held:
            held.append(load(path))
        return _join_row(table, held[0], finish, joined_schema)

    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    long = F.char_length("text") > piece_chars
    short = texts.where(~long).mapInArrow(functools.partial(_short, path=path, finish=finish, schema=schema), sql)
    # A long text is encoded once, however often it is there; its rows then meet their ids.
    keyed = texts.where(long).select(F.sha2("text", 256).alias("row"), "id", "text")
    cut = keyed.groupBy("row").agg(F.first("text").alias("text")).mapInArrow(functools.partial(_pieces, most=piece_chars), PIECES_SQL)
    once = (
        cut.repartition("row", "piece")
        .mapInArrow(functools.partial(_encode_pieces, path=path), ENCODED_SQL)
        .groupBy("row")
        .applyInArrow(joined, joined_sql)
    )
    return short.unionByName(keyed.select("row", "id").join(once, "row").select("id", *columns))
