"""Alignment of two tokenizers against whole texts, token by token."""

import collections
import random

import numpy as np
import pytest

from millrace.llm import alignment
from millrace.llm.queries import tokenizer_path
from llm_tables import empty_docs, prose  # noqa: F401  (fixtures)

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
PARTS = ["a", "the", "ing", "'s", "'", "!!", "1", "é", "é", "中文", "。", "한", "<|endoftext|>", "<s>", "<0x0A>", "ABC", " ", "  ", "\n",
         "\r\n", "\r", "\t", "\x1c", "\x85", "\xa0", "　", "🙂", "ﬁ", "Σ", "\x00", " ", ";\r", "\x0b"]


def text_of(seed, n, spaces=12):
    pick = random.Random(seed)
    return "".join(pick.choice(PARTS + [" "] * spaces) for _ in range(n))


class Whole:
    """Both tokenizers' own libraries on whole texts."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        of = alignment._bytes_of_characters()
        self.bytes_a = {i: t.encode() if t.startswith("<|") else bytes(of[c] for c in t) for t, i in self.a.get_vocab().items()}

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, self.bytes_a[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        same = all(b"".join(x for _, x in own) == (" " + text).encode() for own in (a, b))
        return (a, b) if same else ([], [])


def brute(rows):
    whole, found, counts = Whole(), [], collections.Counter()
    for i, text in rows:
        a, b = whole.tokens(text)
        spans = []
        for own in (a, b):
            at, out = 0, []
            for one, raw in own:
                out.append((one, at, at + len(raw)))
                at += len(raw)
            spans.append(out)
        links = [(x, y) for x, s, e in spans[0] for y, t, f in spans[1] if s < f and t < e]
        counts.update(links)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = []
        for s, e in zip([0, *ends], ends):
            sides = [",".join(str(x) for x, _, f in own if s < f <= e) for own in spans]
            groups.append("|".join(sides))
        found.append((i, len(a), len(b), len(groups), links, ";".join(groups)))
    most = collections.Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted((
        (i, a, b, g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), text or None)
        for i, a, b, g, links, text in found
    ), key=repr)


def test_stretches_and_fragments_make_the_whole():
    pair, whole = alignment.Pair(*PATHS), Whole()
    assert pair.a.fast is not None and pair.b.joined == {"\r"}
    for seed in range(150):
        text = text_of(seed, random.Random(seed).randrange(1, 120), seed % 20)
        a, b = whole.tokens(text)
        stretches = pair.pattern.findall(" " + text)
        assert "".join(stretches) == " " + text
        parts_a, parts_b, good = pair.encoded(stretches)
        if not good.all():
            assert not a
            continue
        assert [i for x in parts_a for i in x] == [i for i, _ in a]
        assert [i for x in parts_b for i in x] == [i for i, _ in b]


@pytest.mark.parametrize("chunk_bytes", [3, 16, 100])
def test_fragments_join_in_any_order(chunk_bytes):
    """The monoid is associative: joined from the left or by halves, the same groups are closed."""
    pair = alignment.Pair(*PATHS)
    for seed in range(25):
        text = text_of(seed, 60) + "x" * 40 + " end"
        raw = (" " + text).encode()
        cuts = np.concatenate([[0], np.cumsum([len(s.encode()) for s in pair.pattern.findall(" " + text)])])
        rows = []
        for n, (low, high) in enumerate(alignment.ranges_of(cuts, chunk_bytes)):
            base, end = cuts[cuts <= low].max(), cuts[cuts >= high].min()
            rows.append(alignment.fragment(pair, "k", n, low, high, int(base), raw[base:end].decode()))
        if not all(r[0]["good"] for r in rows):
            continue
        runs = [run for _, *own in rows for run in own]

        def halves(own, out):
            if len(own) == 1:
                return own[0]
            left, right = halves(own[: len(own) // 2], out), halves(own[len(own) // 2 :], out)
            both, closed = alignment.joined(left, right)
            out += [closed] if closed else []
            return both

        def one_by_one(own, out):
            now = own[0]
            for other in own[1:]:
                now, closed = alignment.joined(now, other)
                out += [closed] if closed else []
            return now

        results = []
        for way in (halves, one_by_one):
            out = list(runs)
            last = way([r[0] for r in rows], out)
            out.append(alignment._run("k", 2 * last["at"] + 1, last["last_a"], last["last_b"]))
            results.append(sorted((r["run"], r["first_a"], r["first_b"]) for r in out))
            assert last["first_a"] == last["first_b"] == b""
        assert results[0] == results[1]
        a = b"".join(x[1] for x in results[0])
        assert np.frombuffer(a, "<u4").tolist() == [i for x in pair.encoded(pair.pattern.findall(" " + text))[0] for i in x]


def test_ranges():
    cuts = np.array([0, 5, 40, 44, 52, 60])
    ranges = alignment.ranges_of(cuts, 10)
    assert ranges == [(0, 5), (5, 40), (40, 50), (50, 60)]
    assert alignment.ranges_of(np.array([0, 7]), 10) == [(0, 7)]


@pytest.mark.parametrize("options", [{}, {"long_bytes": 50, "chunk_bytes": 16, "fan": 2, "block_bytes": 300}])
def test_same_as_brute_force(spark, options):
    rows = [(i, prose(i, 3 + i % 40)) for i in range(40)] + [(100 + i, text_of(i, 5 + i * 3)) for i in range(40)]
    rows += [(1, None), (2, ""), (3, " "), (4, "\n"), (5, "▁ x"), (None, "null id"), (None, None), (6, "y" * 300), (6, "y" * 300)]
    rows += [(7, rows[60][1]), (7, rows[60][1]), (8, "中文。" * 60), (9, "long with ▁ in the middle " * 9)]
    found = alignment.aligned(spark.createDataFrame(rows, "doc_id bigint, text string"), *PATHS, **options)
    got = sorted(((*r[:7], r.groups and bytes(r.groups).decode()) for r in found.collect()), key=repr)
    assert got == brute(rows)


def test_nothing_to_align(spark, empty_docs):
    assert alignment.aligned(empty_docs, *PATHS).collect() == []
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in alignment.aligned(none, *PATHS).collect()) == [(i, *[0] * 6, None) for i in (1, 2)]
