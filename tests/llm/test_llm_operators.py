"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import collections
import hashlib
import random
import re
import tracemalloc
import types
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from millrace.llm import (
    alignment, bpe, common, components, cotraining, exact_dedup, line_dedup, lm_scoring, minhash, mixing, quality_rules, resampling,
    sharding, suffix_dedup, surrogates,
)
from millrace.llm.queries import tokenizer_path
from llm_tables import clashing, empty_docs, odd, odd_rows, prose  # noqa: F401  (fixtures)

KEY = b"a key"


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


OPERATORS = {
    "line_dedup": lambda d: line_dedup.line_dedup(d),
    "quality_rules": lambda d: quality_rules.judged(d),
    "minhash": lambda d: minhash.near_groups(d),
    "suffix_dedup": lambda d: suffix_dedup.repeated_strings(d),
    "mixing": lambda d: mixing.mixed(d),
    "exact_groups": lambda d: exact_dedup.exact_groups(d),
    "surrogates": lambda d: surrogates.with_surrogates(d, KEY),
    "lm_scoring": lambda d: lm_scoring.scored(d),
    "cotraining": lambda d: cotraining.quality_scores(d, d.selectExpr("doc_id", "doc_id % 2 as quality")),
    "bpe": lambda d: bpe.encoded(d, tokenizer_path(), piece_chars=1000),
    "alignment": lambda d: alignment.aligned(
        d, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), long_bytes=5000, chunk_bytes=1000
    ),
    "resampling": lambda d: resampling.resampled(d, d.where("doc_id > 6"), n=2, least_words=2, stretch=1000),
    "sharding": lambda d: sharding.sharded(d).select("doc_id", "text", "n_chars", F.octet_length("text"), "shard", "slot"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_for_each_row(name, odd, clashing, empty_docs, odd_rows):
    run = OPERATORS[name]
    got = sorted_rows(run(odd))
    assert len(got) == len(odd_rows)
    assert sorted_rows(run(clashing)) == got
    assert run(empty_docs).collect() == []


def test_lines(odd):
    by_id = collections.defaultdict(list)
    for r in line_dedup.line_dedup(odd).collect():
        by_id[r.id].append(r)
    assert by_id[14][0].n_dropped == 0 and by_id[14][0].n_lines == 4  # the first holder keeps its repeats
    assert by_id[15][0].text == "another one of fifteen\r\nshort\nshort" and by_id[15][0].n_dropped == 1
    assert by_id[4][0].n_lines == by_id[5][0].n_lines == 1
    assert by_id[2][0].text == "" and by_id[1][0].n_dropped == 0
    assert sorted(r.n_dropped for r in by_id[None]) == [0, 1]  # a null identifier comes last


def test_bitmap_of_many_lines(spark):
    texts = [(1, "\n".join(f"a shared line {i}" for i in range(0, 500, 3))), (2, "\n".join(f"a shared line {i}" for i in range(500)))]
    rows = {r.id: r for r in line_dedup.line_dedup(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert rows[2].n_dropped == 167
    assert rows[2].text.split("\n") == [f"a shared line {i}" for i in range(500) if i % 3]


def test_key_of_many_bands(spark):
    step = 1 << line_dedup.BAND_BITS
    texts = [(i * step // 2, f"the same line everywhere\nown line number {i}") for i in range(9, 0, -1)]
    rows = {r.id: r.n_dropped for r in line_dedup.line_dedup(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert rows == {i * step // 2: int(i > 1) for i in range(1, 10)}


def test_measures(spark):
    text = "a b c a b c\n\n A#b c$\na b c a b c\nx"
    row = quality_rules.judged(spark.createDataFrame([(1, text, "s")], "doc_id bigint, text string, source string")).first()
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    parts = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, p in enumerate(parts) if parts.count(p) > 1 for k in range(3)}
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines) == (len(words), sum(map(len, words)), 2, 1)
    assert row.n_repeat_words == len(covered)


def test_bad_host_takes_its_documents(spark):
    clean = [(i, prose(i, 80), "good") for i in range(300)]
    junk = [(1000 + i, prose(i, 80).replace(" ", "# ") if i % 10 else prose(i, 80), "bad") for i in range(300)]
    few = [(2000, prose(7, 80).replace(" ", "# "), "small"), (2001, prose(8, 80), "small")]
    docs = spark.createDataFrame(clean + junk + few, "doc_id bigint, text string, source string")
    kept = {r.id: r.kept for r in quality_rules.judged(docs).collect()}
    assert all(kept[i] for i, *_ in clean)
    assert not any(kept[i] for i, *_ in junk)
    assert kept[2000] and kept[2001]  # two documents do not make a verdict


def test_prior_follows_hosts():
    alike = quality_rules.beta_prior(100, 1000, 10 * 10**2 / 100, 10)
    apart = quality_rules.beta_prior(100, 1000, 1 * 100**2 / 100, 10)
    assert alike[0] == apart[0] == 0.1
    assert alike[1] == 1000 and apart[1] == 1


def brute_components(texts, percent):
    sets = {}
    for i, t in texts:
        words = (t or "").encode().lower().split()
        n = min(5, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                least[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("percent", [85, 80])
def test_groups_of_near_copies(spark, monkeypatch, percent):
    """Copies of one text with changes of their own: copies are often linked by the original only, which comes late."""
    pick = random.Random(percent)
    texts = []
    for group in range(4):
        base = prose(group, 220).split()
        for k in range(25):
            own = list(base)
            for _ in range(pick.randrange(1, 9)):
                own[pick.randrange(len(own))] = f"w{pick.randrange(10**6)}"
            texts.append((len(texts), " ".join(own)))
        texts.append((len(texts), " ".join(base)))
    texts += [(len(texts) + i, t) for i, t in enumerate(["", None, "two words", "Two  WORDS\n", prose(99, 50)])]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    for star in (512, 7):  # in one task a star, and in parts
        monkeypatch.setattr(minhash, "STAR", star)
        got = {r.id: (r.n_shingles, r.component) for r in minhash.near_groups(docs, percent=percent).collect()}
        assert got == brute_components(texts, percent)


def test_near_copies_of_odd_rows(odd):
    found = collections.defaultdict(set)
    for r in minhash.near_groups(odd).collect():
        found[r.id].add(r.component)
    assert found[None] == {None}  # a null identifier is linked with nothing
    assert found[1] == found[2] == found[3] == {1} and found[8] == {7}
    assert found[4] == {4} and found[5] == {5} and found[6] == {6}  # no words
    assert found[11] == found[12] == {11}  # two words are one shingle


def test_texts_that_share_an_identifier(spark):
    """Each keeps its own links, in any order of the rows."""
    a, b, c = prose(1, 120), prose(2, 120), prose(3, 120)
    texts = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, c), (4, b + " stop"), (5, c + " end"), (4, b + " stop")]
    want = {(1, a): 1, (1, b): 1, (2, a + " end"): 1, (3, b + " end"): 1, (4, c): 4, (4, b + " stop"): 1, (5, c + " end"): 4}
    for rows in (texts, texts[::-1]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        tags = {(r.doc_id, r.tag): r.text for r in docs.select("doc_id", "text", F.xxhash64("text").alias("tag")).collect()}
        found = minhash.near_groups(docs).collect()
        assert {(r.id, tags[r.id, r.tag]): r.component for r in found} == want and len(found) == 8
        stays = [r for r in found if r.id == r.component and r.tag == r.component_tag]
        assert sorted(r.id for r in stays) == [1, 1, 4]  # both texts of 1, as they are not alike


def test_counts_of_common_elements():
    pick = np.random.default_rng(5)
    sets = [np.unique(pick.integers(0, 400, pick.integers(0, 200), dtype=np.uint64)) for _ in range(30)]
    sets += [np.unique(pick.integers(0, 10**6, 50, dtype=np.uint64)) for _ in range(5)]
    got = minhash.common_counts(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert i == j or got[i, j] == len(np.intersect1d(a, b))


def test_signature_is_of_minima():
    sets = [minhash.shingles(prose(i, 300)) for i in range(3)] + [minhash.shingles("a")]
    both = minhash.signatures(sets, 50)
    for i, s in enumerate(sets):
        assert np.array_equal(minhash.signatures([s], 50)[0], both[i])
    a, b = minhash.shingles(prose(5, 2000)), minhash.shingles(prose(5, 2000)[: len(prose(5, 2000)) * 9 // 10])
    alike = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    rough = (minhash.signatures([a], 1000) == minhash.signatures([b], 1000)).mean()
    assert abs(alike - rough) < 0.05


def test_components_of_a_long_path(spark):
    pick = random.Random(1)
    order = list(range(200))
    pick.shuffle(order)
    edges = list(zip(order, order[1:])) + [(1000 + i, 1000) for i in range(1, 50)] + [(5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).df.collect()}
    assert got == {**{i: 0 for i in range(200)}, **{1000 + i: 1000 for i in range(50)}}


@pytest.mark.parametrize("edges, rounds", [
    ([(7, 1), (3, 1), (1, 5), (9, 8)], 0),  # stars
    ([(7, 1), (3, 7), (4, 1)], 1),
    ([], 0),
])
def test_rounds_end_with_stars(spark, monkeypatch, edges, rounds):
    """No round is spent on finding that nothing changes."""
    labels, write = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, label: labels.append(label) or write(df, label))
    found = components.components(spark.createDataFrame(edges, "u bigint, v bigint")).df.collect()
    assert labels.count("small-star") == rounds
    want = {1: 1, 3: 1, 4: 1, 5: 1, 7: 1, 8: 8, 9: 8}
    assert {r.node: r.component for r in found} == {i: want[i] for e in edges for i in e}


def brute_strings(texts, length):
    starts = collections.Counter(x[i : i + length] for _, x in texts for i in range(len(x) - length + 1))
    out = []
    for i, x in texts:
        gone = bytearray(len(x))
        for k in range(len(x) - length + 1):
            if starts[x[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(x), sum(gone), runs, bytes(b for b, g in zip(x, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most_members", [4096, 1])
def test_strings_that_repeat(spark, most_members):
    pick = random.Random(3)
    parts = [prose(i, n) for i, n in enumerate([30, 45, 60, 80, 130])]
    texts = []
    for i in range(40):
        own = [pick.choice(parts) if pick.random() < 0.5 else prose(100 + i * 9 + k, pick.randrange(5, 60)) for k in range(5)]
        texts.append((i, " ".join(own)[pick.randrange(30) :]))
    texts += [(50, "ab" * 600), (51, "z" * 399), (52, "y" * 401), (53, "é" * 300), (54, ""), (55, texts[0][1]), (55, texts[0][1])]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = suffix_dedup.repeated_strings(docs, most_members=most_members)
    assert sorted(((*r[:4], bytes(r[4])) for r in got.collect()), key=repr) == brute_strings([(i, t.encode()) for i, t in texts], 400)


def test_anchors_of_stretches(monkeypatch):
    """A text that is looked at in stretches has windows under the same anchors as in one go."""
    text = prose(4, 3000).encode()
    whole = suffix_dedup.anchors_of(text)
    monkeypatch.setattr(suffix_dedup, "LONGEST", 5000)
    parts = suffix_dedup.anchors_of(text)
    flat = lambda rows: {(w, r[1]) for r in rows.tolist() for w in range(r[2], r[3] + 1)}
    assert flat(parts) == flat(whole) and len({w for w, _ in flat(whole)}) == len(text) - 399


def test_sorted_like_bytes():
    pick = np.random.default_rng(1)
    rows = pick.integers(0, 3, (300, 48), dtype=np.uint8)
    first = pick.integers(0, 4, 300)
    order = suffix_dedup.sample_ranks(rows, first)
    keys = [(first[i], rows[i].tobytes()) for i in order]
    assert keys == sorted(keys)


def test_mix_of_shards(spark):
    texts = [(i, prose(i, 1 + i % 90), "abcd"[min(3, i % 7)] if i % 11 else None) for i in range(700)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, source string")
    rows = mixing.mixed(docs, shard_words=500).collect()
    sizes, taken, targets = collections.Counter(), collections.Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
    weights = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1]))
    wanted, left, open_ = {}, 1.5 * sum(sizes.values()), set(sizes)
    while True:  # share by weight, stop at twice the size, share again
        share = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            break
        for s in full:
            wanted[s] = 2.0 * sizes[s]
            left -= wanted[s]
        open_ -= full
    wanted |= share
    for s in sizes:
        assert targets[s] == pytest.approx(wanted[s])
        assert abs(taken[s] - wanted[s]) <= mixing.BLOCK_WORDS * 2
    assert sorted(map(tuple, mixing.mixed(docs, shard_words=500).collect()), key=repr) == sorted(map(tuple, rows), key=repr)


def test_sainte_lague(spark):
    votes = [53, 24, 23, 7, 3.5, 0.2]
    for seats in (1, 5, 16, 111):
        got = mixing.sainte_lague(spark.createDataFrame(
            [(0, i, float(v), sum(votes), seats, len(votes)) for i, v in enumerate(votes)],
            "part int, unit bigint, votes double, all_votes double, seats bigint, n_units bigint",
        ))
        quotients = sorted(((v / (2 * k + 1), -i) for i, v in enumerate(votes) for k in range(seats)), reverse=True)
        want = collections.Counter(-i for _, i in quotients[:seats])
        assert {r.unit: r.blocks for r in got.collect()} == {i: want[i] for i in range(len(votes))}


def test_equal_texts(odd, odd_rows):
    for largest in (False, True):
        rows = exact_dedup.exact_groups(odd, largest=largest).collect()
        groups = collections.defaultdict(list)
        for i, t, *_ in odd_rows:
            groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
        kept = collections.Counter(r.sha for r in rows if r.kept)
        assert kept == {s: 1 for s in groups}
        for r in rows:
            known = [i for i in groups[r.sha] if i is not None]
            want = (max if largest else min)(known, default=None)
            assert (r.keep_id, r.group_size) == (want, len(groups[r.sha]))


def test_copies_over_many_slices(spark):
    texts = [(i, "the same" if i % 3 else f"own {i}") for i in range(4000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = exact_dedup.exact_groups(docs).where("group_size > 1").collect()
        left = exact_dedup.exact_dedup(docs).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    same = [i for i, t in texts if t == "the same"]
    assert {(r.keep_id, r.group_size) for r in rows} == {(1, len(same))}
    assert [r.id for r in rows if r.kept] == [1]
    assert sorted(r.doc_id for r in left) == sorted([1, *[i for i, t in texts if t != "the same"]])


def test_kept_rows_have_their_columns(clashing):
    left = exact_dedup.exact_dedup(clashing)
    assert left.dtypes == clashing.dtypes
    texts = [r.text for r in left.collect()]
    assert len({t or "" for t in texts}) == len(texts)


def test_first_rows_of_runs():
    """Of two columns, nulls equal nulls; a run may go on from an earlier batch."""
    batch = pa.RecordBatch.from_pydict({"sha": ["a", "a", "a", None, None, "b", "b"], "text": ["x", "x", "y", None, None, None, "z"]})
    for before, first in ((None, [0]), (("a", "x"), []), (("a", "y"), [0])):
        assert exact_dedup._first_rows(batch, before).tolist() == [*first, 2, 3, 5, 6]
    assert exact_dedup._first_rows(batch.slice(6), ("b", None)).tolist() == [0]
    assert exact_dedup._first_rows(batch.slice(4), (None, None)).tolist() == [1, 2]


def test_texts_come_in_small_batches(spark):
    """A worker gets texts by their bytes, not thousands at a time."""
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)
    texts = spark.range(0, 2000, 1, 1).selectExpr("repeat('x', 1000) as text")
    found = common.stored(texts.mapInArrow(sizes, "n bigint"), "test", "100k").df.collect()
    assert sum(r.n for r in found) == 2000 and max(r.n for r in found) <= 200


def test_shuffles_go_when_a_table_is_written(spark):
    """Their files do not wait for the driver's garbage collection."""
    on_disk = lambda: {
        str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",").split(",") if "shuffle_" in f
    }
    before = on_disk()
    table = common.stored(spark.range(10000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "test").df
    assert not on_disk() - before and table.count() == 7
    assert spark.conf.get(common.SHUFFLES_GO, "false") == "false"


NAMED = (
    "Mr. John Smith (john.smith@mail.example.com, JOHN.smith@mail.example.com) called +1 (663) 555-6869 and 1-663-555-6869 "
    "from 10.0.0.1. Smith paid with 4111 1111 1111 1111 and 4111111111111111. Frau Anna Müller, Г-жа Иванова, 王伟先生. "
    "IBAN DE89 3704 0044 0532 0130 00, ssn 123-45-6789, password: hunter2abc; 1 2 3 4 5 6 7 8 9 10 11 12 13 14 are numbers."
)


def test_surrogates_keep_their_kind():
    found = surrogates.mentions(NAMED)
    new = {}
    for m in found:
        made = surrogates.surrogate(KEY, m.kind, m.shape, surrogates.digest_of(KEY, m.kind, m.shape, m.canonical), 0)
        new[NAMED[m.start : m.end]] = surrogates.render(NAMED[m.start : m.end], m.kind, made)
    assert len(found) == 17 and not set(new) & set(new.values())
    plain = lambda x: re.sub(r"\D", "", x)
    assert plain(new["+1 (663) 555-6869"]) == plain(new["1-663-555-6869"])
    assert plain(new["4111 1111 1111 1111"]) == new["4111111111111111"] and surrogates.luhn(new["4111111111111111"]) == 0
    assert new["john.smith@mail.example.com"].lower() == new["JOHN.smith@mail.example.com"].lower()
    assert surrogates.iban_rest(new["DE89 3704 0044 0532 0130 00"].replace(" ", "")) == 1
    assert surrogates.script_of(new["Иванова"]) == "cyrillic" and new["Иванова"].endswith("а")
    assert new["Anna"][-1] in "ae" and surrogates.script_of(new["王伟"]) == "han"
    assert sum(NAMED[m.start : m.end] == "Smith" for m in found) == 2
    assert "1 2 3 4 5" not in new


def test_surrogates_are_distinct(spark):
    """A shape with a thousand values, taken by six hundred: later claims move on until all are distinct."""
    shape = "\\s000"
    own = [f"s{i:03d}" for i in range(0, 1000, 3)]
    rows = [("secret", shape, surrogates.digest_of(KEY, "secret", shape, x)) for x in own]
    entities = spark.createDataFrame(rows, "kind string, shape string, digest string")
    later = surrogates.distinct_attempts(entities, KEY)
    attempts = {r.digest: r.attempt for r in later.collect()}
    made = [surrogates.surrogate(KEY, *r, attempts.get(r[2], 0)) for r in rows]
    assert attempts and len(set(made)) == len(own) and not set(made) & set(own)


def test_names_are_distinct_over_shapes(spark):
    """Given and family names of all genders, in texts of their own."""
    letters = "abcdefghijklmnopqrst"
    names = [f"Q{a}{b}{c}" for a in letters for b in letters for c in "aeiou"]
    people = [(t, names[3 * i], names[3 * i + 1]) for i, t in enumerate(["Dr", "Mr", "Mrs"] * 200)]
    docs = spark.createDataFrame([(i, f"{t} {a} {b}") for i, (t, a, b) in enumerate(people)], "doc_id bigint, text string")
    new = [w for r in surrogates.with_surrogates(docs, KEY).collect() for w in r.text.split()[1:]]
    assert len(new) == len(set(new)) == 1200

    # A surrogate is no name of the corpus either, whatever the kind or gender.
    first = surrogates.with_surrogates(docs, KEY).where("id = 0").first().text.split()[1]
    more = docs.union(spark.createDataFrame([(9999, f"Mr Qzzz {first}")], docs.schema))
    taken = {w for r in surrogates.with_surrogates(more, KEY).collect() for w in r.text.split()[1:]}
    assert first not in taken and len(taken) == 1202


def test_documents_with_exceptions(spark):
    """Numbers of a narrow shape in documents: all mentions of one are replaced alike, of two never alike."""
    texts = [(i, f"password: k{i % 700:03d}xy and password: k{(i * 7) % 700:03d}xy") for i in range(900)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    new = {}
    for r in surrogates.with_surrogates(docs, KEY).collect():
        for old, put in zip(re.findall(r": (\S+)", texts[r.id][1]), re.findall(r": (\S+)", r.text)):
            assert new.setdefault(old, put) == put
    assert len(set(new.values())) == len(new) and not set(new) & set(new.values())


def test_levels_are_found_again():
    pick = np.random.default_rng(2)
    keys = np.unique(pick.integers(0, 2**63, 5000, dtype=np.uint64))
    counts = np.maximum(1, pick.pareto(0.8, len(keys)).astype(np.int64))
    levels = lm_scoring.level_of(counts)
    segment = lm_scoring.Filter.segment(keys, 4)
    words = np.stack([lm_scoring.build_segment(keys[segment == s], levels[segment == s], 1, 1 << 18) for s in range(4)])
    found = lm_scoring.Filter(words, 1)
    assert (found.levels(keys) >= levels).all() and (found.levels(keys) == levels).mean() > 0.99
    others = np.setdiff1d(pick.integers(0, 2**63, 5000, dtype=np.uint64), keys)
    assert (found.levels(others) > 0).mean() < 0.01
    assert np.allclose(lm_scoring.count_of(levels[counts <= 2]), counts[counts <= 2], atol=0.6)


def test_words_meet_their_counts(spark):
    """Exact counts come back from every segment, however many there are."""
    texts = [(i, prose(i, 60)) for i in range(60)] + [(100, "never seen before"), (101, "")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = lm_scoring.scored(docs).collect()
    words = {i: t.lower().split() + [""] for i, t in texts}
    counts = collections.Counter(w for r in rows if not r.held_out for w in words[r.id])
    for r in rows:
        want = sum(np.log10((counts[w] + 0.1) / (counts.total() + 0.1 * (len(counts) + 1))) for w in words[r.id])
        assert r.n_known == sum(counts[w] > 0 for w in words[r.id]) and np.isclose(r.base_score, want, rtol=1e-12)
        assert r.train_tokens == counts.total()
    many = lm_scoring.scored(docs, segment_bytes=300).collect()
    assert sorted((r.id, r.n_known, r.base_score) for r in many) == sorted((r.id, r.n_known, r.base_score) for r in rows)


def test_packed_keys():
    pick = np.random.default_rng(4)
    flat = np.concatenate([pick.integers(0, 2**63, 300, dtype=np.uint64), [lm_scoring.END]])
    keys = lm_scoring.sorted_once(np.concatenate([flat, lm_scoring.pairs(flat), flat]))
    assert np.array_equal(keys, np.unique(keys)) and len(keys) == len(np.unique(np.concatenate([flat, lm_scoring.pairs(flat)])))
    assert np.array_equal(lm_scoring.unpacked_keys(lm_scoring.packed_keys(keys)), keys)
    assert len(lm_scoring.unpacked_keys(lm_scoring.packed_keys(keys[:0]))) == 0
    segment = lm_scoring.Filter.segment(keys, 7)
    assert set(segment) == set(range(7)) and all((np.diff(segment[part]) >= 0).all() for part in (keys < lm_scoring.PAIR, keys >= lm_scoring.PAIR))


def brute_scores(docs, trained):
    """Scores from the levels of exact counts."""
    texts = {i: t.split() + [" "] for i, t in docs}
    ones = collections.Counter(w for i in trained for w in texts[i])
    twos = collections.Counter(p for i in trained for p in zip([" ", *texts[i]], texts[i]))
    near = lambda n: float(lm_scoring.count_of(lm_scoring.level_of(np.array([n])))[0]) if n else 0.0
    spread, out = ones.total() + lm_scoring.ADD * (len(ones) + 1), {}
    for i, words in texts.items():
        out[i] = 0.0
        for v, w in zip([" ", *words], words):
            context, word = near(ones[v]), (near(ones[w]) + lm_scoring.ADD) / spread
            out[i] += np.log10((min(near(twos[v, w]), context) + lm_scoring.WEIGHT * word) / (context + lm_scoring.WEIGHT))
    return out


def far_scores(spark, texts, **options):
    """How far the scores are from the exact levels', in parts of these."""
    got = {r.id: r for r in lm_scoring.scored(spark.createDataFrame(texts, "doc_id bigint, text string"), **options).collect()}
    want = brute_scores(texts, [i for i, r in got.items() if not r.held_out])
    return np.array([abs(got[i].score / want[i] - 1) for i in want])


def test_every_level_is_kept(spark):
    """Many segments hold the n-grams of the lowest levels too, whatever a segment's size."""
    texts = [(i, " ".join(f"own{i // 20}x{j} and" for j in range(40))) for i in range(200)]
    for size in (1 << 22, 3000):
        far = far_scores(spark, texts, segment_bytes=size)
        assert np.median(far) < 0.005 and far.max() < 0.05


def test_bigrams_seen_once_count(spark):
    far = far_scores(spark, [(i, f"the own{i} and last{i}") for i in range(200)])
    assert np.median(far) < 0.005 and (far < 0.02).mean() > 0.9


def scoring_steps(monkeypatch, texts, segments):
    """Scores without Spark, and the most bytes that counting and scoring held, input and arrays of Arrow left out."""
    here = types.SimpleNamespace(partitionId=lambda: 0)
    monkeypatch.setattr(lm_scoring, "TaskContext", types.SimpleNamespace(get=lambda: here))
    docs = pa.RecordBatch.from_pydict({"id": [i for i, _ in texts], "held_out": [i % 10 == 0 for i, _ in texts], "text": [t for _, t in texts]})
    by = lambda batches, *keys: pa.Table.from_batches(batches).sort_by([(k, "ascending") for k in keys]).to_batches()
    peaks = []

    def traced(batches):
        tracemalloc.start()
        out = list(batches)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        return out

    blocks = list(lm_scoring._blocks(iter([docs])))
    counted = traced(lm_scoring._counted(iter([b.select(["held_out", "sizes", "words", "places"]) for b in blocks]), segments))
    built = list(lm_scoring._built(iter(by(counted, "segment"))))
    filters = [
        pa.RecordBatch.from_arrays([b["segment"], pa.array([-1] * len(b)), pa.array([0] * len(b)), b["words"], b["keys"], b["counts"]], schema=lm_scoring.ASKED)
        for b in built
    ]
    asked = list(lm_scoring._asked(iter(blocks), segments))
    answers = list(lm_scoring._answered(iter(by(filters + asked, "segment", "block"))))
    blocks = [b.append_column("run", pa.array([-1] * len(b))) for b in blocks]
    of = lambda b: pc.equal(pa.Table.from_batches(answers)["block"], b["block"][0])
    rows = [x for b in blocks for x in [b, *pa.Table.from_batches(answers).filter(of(b)).to_batches()]]
    total, distinct = (sum(sum(b[c].to_pylist()) for b in built) for c in ("total", "known"))
    found = traced(lm_scoring._scored(iter(rows), total, distinct, lm_scoring.WEIGHT, segments))
    return sorted(map(tuple, pa.Table.from_batches(found).to_pandas().values.tolist())), peaks


@pytest.mark.parametrize("segments", [1, 5])
def test_scores_by_pieces(monkeypatch, segments):
    """Pieces and blocks of any size score alike, with texts longer and shorter than a piece, empty ones too."""
    texts = [(i, " ".join(f"w{(i * j) % 37}" for j in range(i % 23))) for i in range(120)] + [(500, "long " * 200), (501, "")]
    whole, _ = scoring_steps(monkeypatch, texts, segments)
    assert [r[0] for r in whole] == [i for i, _ in texts]
    monkeypatch.setattr(lm_scoring, "PIECE", 7)
    monkeypatch.setattr(lm_scoring, "OUT_BYTES", 1)
    assert scoring_steps(monkeypatch, texts, segments)[0] == whole
    monkeypatch.setattr(lm_scoring, "BLOCK", 50)
    monkeypatch.setattr(lm_scoring, "FLUSH", 90)
    assert scoring_steps(monkeypatch, texts, segments)[0] == whole


def test_blocks_that_are_all_held_out(spark):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = lm_scoring.scored(spark.createDataFrame([(i, "a b a") for i in ids], "doc_id bigint, text string").repartition(3)).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in rows] == [(True, 4, 0, 0)] * len(ids) and ids
    assert not len(lm_scoring.pairs(np.empty(0, np.uint64)))


def test_scoring_holds_little(monkeypatch):
    """A worker holds few bytes for each token that it counts or scores."""
    pick = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(60_000)])
    texts = [(i, " ".join(words[(pick.pareto(0.6, 400) * 50).astype(np.int64) % len(words)])) for i in range(1000)]
    rows, (counting, scoring) = scoring_steps(monkeypatch, texts, 20)
    tokens = sum(r[2] for r in rows)
    assert tokens == 401_000
    assert counting < 40 * tokens and scoring < 40 * tokens


def test_scoring_goes_by_small_batches(spark, monkeypatch):
    """Blocks, segments and scores are all worked out in batches of few bytes."""
    seen = []
    monkeypatch.setattr(lm_scoring, "stored", lambda df, label, *size: seen.append((label, *size)) or common.stored(df, label, *size))
    assert lm_scoring.scored(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")).count() == 2
    assert seen == [(label, lm_scoring.BATCH) for label in ("blocks", "segments", "scores")]


def test_without_labels_of_both_kinds(odd):
    none = odd.selectExpr("doc_id", "cast(null as int) as quality")
    good = odd.selectExpr("doc_id", "1 as quality")
    assert {r.score for r in cotraining.quality_scores(odd, none).collect()} == {1.0}
    assert {r.score for r in cotraining.quality_scores(odd, good).collect()} == {1.0}


def test_views_teach_each_other():
    """Few labels; either view alone tells good from bad, but the held-out texts share no word with the labelled."""
    pick = random.Random(4)
    rows, truth = [], []
    for i in range(600):
        good = pick.random() < 0.6
        vocabulary = ["kind", "calm", "plain"] if good else ["spam", "click", "win"]
        words = [f"{pick.choice(vocabulary)}{pick.randrange(12)}" for _ in range(12)]
        rows.append((" ".join(words), "en", "good" if good else "bad"))
        truth.append(float(good))
    labels = np.array([t if i < 60 else -1 for i, t in enumerate(truth)]).astype(int)
    views = cotraining.both_views(*map(list, zip(*rows)))
    held = (labels >= 0) & (np.arange(600) % 5 == 0)
    batch = cotraining.Batch.begun(views, labels, held)
    some = [r.take(np.arange(60)) for r in views]
    model = cotraining.cotrain(cotraining.Local([batch]), cotraining.Local([cotraining.Batch.begun(some, labels[:60], held[:60])]), 540)
    scores = cotraining.combined(model, views)
    assert ((scores >= 0.5) == (np.array(truth) == 1))[60:].mean() > 0.97


def test_sums_in_tasks_are_those_in_memory(spark, odd):
    """One round of sums, thresholds and marks over a written table and in memory."""
    pick = random.Random(8)
    rows = [(i, prose(i, 20) + (" spam" * pick.randrange(3)), "en", "s", i % 2 if i < 40 else -1, i % 5 == 0 and i < 40) for i in range(200)]
    docs = spark.createDataFrame(rows, "id bigint, text string, lang string, source string, label int, held boolean").repartition(5)
    table = cotraining.stored(docs.mapInArrow(cotraining._featured, cotraining.FEATURES_SQL), "test").df
    spread = cotraining.Spread(table)
    local = cotraining.Local([cotraining._unpacked(b) for b in table.toArrow().combine_chunks().to_batches()])
    size = cotraining.SIZE
    assert np.array_equal(spread.total(cotraining.class_sums, 4 * size + 4), local.total(cotraining.class_sums, 4 * size + 4))
    models = [np.random.default_rng(v).normal(size=size + 1) for v in range(2)]
    each = np.full((2, 2, 2), 0.01)
    of = lambda b: cotraining.slopes(b, models, each)
    assert np.allclose(spread.total(of, 2 * size + 2), local.total(of, 2 * size + 2), atol=400)  # batches are rounded apart
    scales = [(1.0, 0.0), (0.5, 0.1)]
    counts = lambda b: cotraining.odds_counts(b, models, scales)
    found = spread.total(counts, 2 * (2 * 30 * 256 + 1)).reshape(2, -1)
    assert found.sum() == 320 and np.array_equal(found, local.total(counts, found.size).reshape(2, -1))
    odds = np.sort(cotraining.steps_of(local.batches[0].odds(models)[0])[local.batches[0].label < 0])
    bounds, n_good, n_bad = cotraining.bounds_of(found[0], 40, 0.5)
    assert n_good == (odds >= bounds[1]).sum() <= 20 and n_bad == (odds <= bounds[0]).sum() <= 20
    more = spread.marked(lambda b: cotraining.taught_marks(b, models, scales, [bounds, (-99999, 99999)]), cotraining.Spread(table.limit(0)))
    marks = collections.Counter(r.learn1 for r in more.df.collect())
    assert marks == {k: n for k, n in ((1, n_good), (0, n_bad)) if n}


def test_each_part_of_a_sum_comes_to_the_driver_once(spark, monkeypatch):
    """However many tasks there are."""
    rows = [(i, prose(i, 20), "en", "s", i % 2, i % 5 == 0) for i in range(100)]
    docs = spark.createDataFrame(rows, "id bigint, text string, lang string, source string, label int, held boolean").repartition(20)
    table = cotraining.stored(docs.mapInArrow(cotraining._featured, cotraining.FEATURES_SQL), "test").df
    seen, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: seen.extend(found := collect(df)) or found)
    size = 4 * cotraining.SIZE + 4
    total = cotraining.Spread(table).total(cotraining.class_sums, size)
    assert total[-4:].tolist() == [40, 40, 10, 10] and sum(len(r.sums) for r in seen) == 8 * size
    none = cotraining.Spread(table.limit(0)).total(cotraining.class_sums, size)
    assert len(none) == size and not none.any()


ALPHABET = ["a", "the", "ing", "'s", "'", "!!", "1", "é", "é", "́", "中文", "한", "<|endoftext|>", "<|end", "ABC", "İ", " ", "\x1c", "🙂", "ﬁ", "Σ"]


@pytest.mark.parametrize("spaces", [0, 6])
def test_joined_encodings(spaces):
    own = bpe.load(tokenizer_path())
    pick = random.Random(spaces)
    for _ in range(40):
        text = "".join(pick.choice(ALPHABET + [" "] * spaces) for _ in range(pick.randrange(1, 900)))
        want = own.encode(text, add_special_tokens=False).ids
        pieces = [bpe.encode_piece(own, t, s) for s, t in bpe.halves(text, pick.choice([40, 150, 400]))]
        assert bpe.join_all(own, pieces).tokens[:, 0].tolist() == want
        assert bpe.Words(own).ids([text])[0].tolist() == want


def test_copies_of_a_long_text(spark):
    """Rows without identifiers share one encoding and stay rows of their own."""
    own = bpe.load(tokenizer_path())
    text = "copied " * 60
    docs = spark.createDataFrame([(None, text)] * 5 + [(1, text), (2, text + "x")], "doc_id bigint, text string")
    got = bpe.encoded(docs, tokenizer_path(), piece_chars=100).collect()
    want = own.encode(text, add_special_tokens=False).ids
    assert sorted(str(r.id) for r in got) == ["1", "2", *["None"] * 5]
    assert all(list(r.ids) == want for r in got if r.id != 2)


def test_lines_without_identifiers(spark):
    """All rows lack one: nothing is dropped; a known identifier comes first."""
    texts = [(None, f"a line in all of them\nown line number {i}") for i in range(50)]
    make = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.n_dropped for r in line_dedup.line_dedup(make(texts)).collect()} == {0}
    more = line_dedup.line_dedup(make([*texts, (7, "a line in all of them")])).collect()
    assert sorted(r.n_dropped for r in more) == [0] + [1] * 50


def test_long_unsplit_text(spark):
    own = bpe.load(tokenizer_path())
    texts = [(1, "abcdefghij" * 9000), (2, "q" * 70000), (2, "q" * 70000), (3, None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = sorted((r.id, list(r.ids)) for r in bpe.encoded(docs, tokenizer_path()).collect())
    assert got == sorted((i, own.encode(t or "", add_special_tokens=False).ids) for i, t in texts)
