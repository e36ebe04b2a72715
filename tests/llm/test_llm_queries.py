"""Queries of the subpackage against their SQL, and against brute force where there is none."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest

from millrace.llm.queries import QUERIES, SQL, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts(folder):
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{folder}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    expected = sorted(want.fetchall(), key=repr)
    got = QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r) for r in got.select(names).collect()), key=repr) == expected


def test_repeated_strings(spark, folder, texts):
    raw = {d: t.encode() for d, t in texts.items()}
    starts = collections.Counter(x[i : i + 400] for x in raw.values() for i in range(len(x) - 399))
    for row in QUERIES["op4_suffix_dedup"](spark, folder).collect():
        x = raw[row.doc_id]
        gone = bytearray(len(x))
        for i in range(len(x) - 399):
            if starts[x[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        left = bytes(b for b, g in zip(x, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        want = (len(x), sum(gone), runs, hashlib.sha256(left).hexdigest())
        assert (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256) == want


def test_base_scores(spark, folder, texts):
    tokens = {d: [*WORD.findall(t.translate(LOWER)), None] for d, t in texts.items()}
    held = {d for d in texts if zlib.crc32(str(d).encode()) % 10 == 0}
    counts = collections.Counter(t for d, x in tokens.items() if d not in held for t in x)
    total = sum(counts.values())
    spread = total + 0.1 * (len(counts) + 1)
    rows = QUERIES["op8_lm_scoring"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        own = tokens[row.doc_id]
        base = sum(math.log10((counts[t] + 0.1) / spread) for t in own)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (row.doc_id in held, len(own), total)
        assert row.n_known == sum(counts[t] > 0 for t in own)
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        assert row.score <= 0
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)  # bigrams help on held-out texts


def test_token_ids(spark, folder, texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    rows = QUERIES["op10_bpe"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = own.encode(texts[row.doc_id], add_special_tokens=False).ids
        decoded = own.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_mix_meets_targets(spark, folder):
    rows = QUERIES["op5_mixing"](spark, folder).collect()
    sources = collections.defaultdict(int)
    targets = {}
    names = dict(duckdb.sql(f"SELECT doc_id, source FROM '{folder}/documents.parquet'").fetchall())
    for row in rows:
        assert 0 <= row.taken <= 2 * row.size
        sources[names[row.doc_id]] += row.taken
        targets[names[row.doc_id]] = row.target
    for name, target in targets.items():
        assert abs(sources[name] - target) <= 16
    assert math.isclose(sum(targets.values()), 1.5 * sum(r.size for r in rows))


def test_personal_data_is_gone(spark, folder, texts):
    from millrace.llm.surrogates import mentions

    rows = {r.doc_id: r for r in QUERIES["op7_surrogates"](spark, folder).collect()}
    found = {t[m.start : m.end] for t in texts.values() for m in mentions(t)}
    assert found
    for doc, text in texts.items():
        assert not any(x in rows[doc].text for x in found)
        if not mentions(text):
            assert rows[doc].text == text


def test_classifier_on_held_out_labels(spark):
    """Two thirds of the labels of a larger table train, the others judge."""
    from millrace.llm import cotraining

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scores = {r.id: r.score for r in cotraining.quality_scores(docs, labels.where("doc_id % 3 != 0")).collect()}
    assert len(scores) == docs.count()
    held = [(scores[r.doc_id] >= 0.5, r.quality == 1) for r in labels.where("doc_id % 3 = 0").collect()]
    assert sum(a == b for a, b in held) >= 0.93 * len(held)
    assert sum(a for a, b in held if b) >= 0.97 * sum(b for _, b in held)  # good documents are kept


def test_every_document_gets_a_score(spark, folder):
    rows = QUERIES["op9_cotraining"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for (d,) in duckdb.sql(f"SELECT doc_id FROM '{folder}/documents.parquet'").fetchall())
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in rows)
