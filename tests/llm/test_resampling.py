"""Resampling by hashed n-grams against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from millrace.llm import resampling
from llm_tables import odd, odd_rows, prose  # noqa: F401  (fixtures)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, n):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, n, buckets, least, percent, seed):
    of = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (collections.Counter(of(g) for _, x in rows for g in grams(x, n)[1]) for rows in (docs, target))
    all_s, all_t = s.total() + buckets, t.total() + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
    rows = []
    for i, x in docs:
        words, own = grams(x, n)
        weight = sum(gain(of(g)) for g in own)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, words, len(own), weight, score))
    may = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = len(may) * percent // 100
    ranks = {}
    for place, r in enumerate(may[:drawn], 1):
        ranks.setdefault(r, []).append(place)
    return sorted(((*r, ranks[r].pop(0) if ranks.get(r) else None) for r in rows), key=repr)


ODD = ["", None, "...", "Ünï ÉÉ 中文 a1_b2", "x" * 500 + " " + "x" * 500 + " " + "x" * 499 + "y", "\x00a\x7fb\x80c", "a" * 31, "a" * 32 + " A"]


@pytest.mark.parametrize(("n", "stretch"), [(1, 1 << 22), (1, 300), (3, 1 << 22), (3, 300)])
def test_same_as_brute_force(spark, n, stretch):
    docs = [(i, prose(i, 5 + i % 60)) for i in range(200)] + [(300 + i, x) for i, x in enumerate(ODD)]
    docs += [(5, docs[5][1]), (None, docs[7][1]), (None, "another text " * 20), (400, prose(9, 3000))]
    target = [(i, prose(1000 + i, 30)) for i in range(10)] + [(0, None)]
    options = dict(n=n, buckets=50, least_words=10, percent=33, seed="s")
    got = resampling.resampled(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(target, "doc_id bigint, text string"),
        stretch=stretch, **options,
    )
    rows = sorted((tuple(r) for r in got.select("id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)
    assert rows == brute(docs, target, n, 50, 10, 33, "s")


def test_empty_target(odd, odd_rows):
    got = resampling.resampled(odd, odd.where("false"))
    rows = [tuple(r) for r in got.select("id", "n_words", "n_features", "weight", "score", "rank").collect()]
    assert sorted(rows, key=repr) == brute([r[:2] for r in odd_rows], [], 1, 10_000, 20, 10, "2024")


def test_keys_are_xxhash64():
    pick = random.Random(1)
    parts = ["".join(pick.choice("abcdé9") for _ in range(n % 80 + 1)) for n in range(400)]
    words = resampling.Words(" ".join(parts).encode() + b"\n")
    got = resampling.xxhash64(words, words.starts, words.ends - words.starts)
    assert got.tolist() == [xxhash.xxh64_intdigest(p.encode()) for p in parts]


def test_equal_hashes_are_told_apart():
    """All keys are one: only the bytes decide."""
    pick = random.Random(2)
    parts = [pick.choice("abcdefgh") * pick.choice([1, 8, 9, 40]) for _ in range(300)]
    words = resampling.Words(" ".join(parts).encode() + b"\n")
    lengths = words.ends - words.starts
    table = resampling.Table(words, words.starts, lengths, 1000, keys=np.full(len(parts), 7, dtype=np.uint64))
    counts = collections.Counter(parts)
    assert len(table.used) == len(counts)
    for part, slot in zip(parts, table.slots.tolist()):
        assert table.count[slot] == counts[part] and table.bucket[slot] == zlib.crc32(part.encode()) % 1000
