"""The pipeline's stages against plain Python, each on what its predecessor kept."""

import collections

import pytest

import corpus_pipeline as pipeline
from millrace.llm import mixing, quality_rules
from millrace.llm.common import stored
from millrace.llm.queries import tokenizer_path
from llm_tables import clashing, empty_docs, odd, odd_rows  # noqa: F401  (fixtures)
from test_llm_operators import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for name, stage in pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], folder), name).df)
        if name != "bpe":
            assert kept[-1].columns == COLUMNS
    rows = [[tuple(r) for r in k.collect()] for k in kept]
    good = {r.id for r in quality_rules.judged(docs).where("kept").collect()}
    assert sorted(rows[1]) == sorted(r for r in rows[0] if r[0] in good)

    first = {}
    for r in sorted(rows[1]):
        first.setdefault(r[1], r)
    assert sorted(rows[2]) == sorted(first.values())

    near = brute_components([r[:2] for r in rows[2]], pipeline.NEAR_PERCENT)
    assert sorted(rows[3]) == sorted(r for r in rows[2] if near[r[0]][1] == r[0])

    times = collections.Counter(rows[4])
    assert set(times) <= set(rows[3]) and max(times.values()) <= 2
    words = sum(len(r[1].encode().split()) * n for r, n in times.items())
    assert abs(words / (1.5 * sum(len(r[1].encode().split()) for r in rows[3])) - 1) < 0.1

    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    ids = {r[0]: own.encode(r[1], add_special_tokens=False).ids for r in rows[4]}
    assert sorted(r[0] for r in rows[5]) == sorted(r[0] for r in rows[4])
    assert all(list(r.ids) == ids[r.doc_id] and r.n_tokens == len(r.ids) for r in kept[5].collect())


def test_run(spark, folder):
    assert pipeline.run(spark, folder).columns == ["doc_id", "ids", "n_tokens"]
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "bpe"]


def test_odd_tables(spark, odd, clashing, empty_docs):
    for name, stage in pipeline.STAGES:
        plain = sorted((tuple(r) for r in stage(spark, odd, "").collect()), key=repr)
        more = stage(spark, clashing, "")
        if name != "bpe":
            assert more.columns == clashing.columns
            assert sorted((tuple(r) for r in more.select(COLUMNS).collect()), key=repr) == plain
        assert stage(spark, empty_docs, "").collect() == []


def test_one_of_repeated_rows(spark, odd):
    """A row that repeats stays once; two texts that share an identifier are two documents."""
    left = [(r.doc_id, r.text) for r in pipeline.keep_one_of_alike(spark, odd, "").collect() if r.doc_id is not None]
    assert len(left) == len(set(left)) and len({t for i, t in left if i == 13}) == 2


@pytest.mark.parametrize("words", [20, 70_000])
def test_every_source_meets_its_target(spark, words):
    """Also where a document is as long as a shard, and each is taken in part."""
    docs = [(i, f"w{i} " * (words + i % 3), "en", "abc"[i % 3], 0) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    want = collections.Counter()
    for r in mixing.mixed(df).collect():
        want[r.source] += r.taken
    got = collections.Counter()
    for r in pipeline.mix(spark, df, "").select("source", "text").collect():
        got[r.source] += r.text.count(" ")
    assert all(abs(got[s] - want[s]) <= words + 2 for s in "abc") and len(set(want.values())) > 1
