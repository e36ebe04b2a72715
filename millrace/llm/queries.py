"""One query per operator, over the whole of its table and with production parameters."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    alignment, bpe, cotraining, exact_dedup, line_dedup, lm_scoring, minhash, mixing, quality_rules, resampling, sharding,
    suffix_dedup, surrogates,
)
from millrace.llm.common import documents
from millrace.llm.registry import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL"]


@query("""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
firsts AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id > f.first, false) AS dropped
  FROM keyed k LEFT JOIN firsts f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines found in at least two documents stay in the first of them only."""
    done = line_dedup.line_dedup(documents(spark, folder))
    return done.select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@query("""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
groups AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
FROM texts t JOIN groups g ON t.text = g.text
""")
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Equal texts; the row with the largest doc_id stays."""
    found = exact_dedup.exact_groups(documents(spark, folder), largest=True)
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


# Fixed value: the words and white space of every contract, in the SQL twins.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(f"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS part
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM texts)),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, part) AS n FROM windows),
covered AS (
  SELECT doc_id, count(DISTINCT p)::BIGINT AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) - count(DISTINCT line))::BIGINT AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
stats AS (
  SELECT t.doc_id, t.source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM texts t LEFT JOIN covered c USING (doc_id) LEFT JOIN lines l USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         [n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words, 10 * n_dup_lines > 3 * n_lines,
          word_chars < 3 * n_words OR word_chars > 10 * n_words] AS failures
  FROM stats),
rated AS (
  SELECT source, rule, count(*)::DOUBLE AS n, sum(failures[rule]::INT)::DOUBLE AS f
  FROM judged, generate_series(1, 5) r(rule) GROUP BY source, rule),
priors AS (
  SELECT rule, sum(f) / sum(n) AS m, sum(n) AS n,
         sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2
           - (sum(f) / sum(n)) * (1 - sum(f) / sum(n)) * count(*) / sum(n) AS between_hosts
  FROM rated GROUP BY rule),
weights AS (
  SELECT rule, m, CASE WHEN m <= 0 OR m >= 1 THEN 1.0 WHEN between_hosts > 0
                       THEN greatest(1.0, m * (1 - m) / between_hosts - 1) ELSE n END AS weight FROM priors),
shrunk AS (
  SELECT source, (f + m * weight) / (n + weight) AS p, n + weight + 1 AS heavy FROM rated JOIN weights USING (rule)),
hosts AS (SELECT source, bool_or(p - 3 * sqrt(p * (1 - p) / heavy) > 0.5) AS rejected FROM shrunk GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged j JOIN hosts h ON j.source IS NOT DISTINCT FROM h.source
""")
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of every document, the base rules, and the verdict on its host."""
    done = quality_rules.judged(documents(spark, folder))
    return done.select(F.col("id").alias("doc_id"), *quality_rules.MEASURES, "base_failed", "kept")


@query(f"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size, md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number
  FROM sized GROUP BY source),
weighed AS (SELECT *, ([3, 1, 2])[(number - 1) % 3 + 1] AS weight FROM sources),
ordered AS (
  SELECT *, sum(source_size) OVER o - source_size AS sizes_before, sum(weight) OVER o - weight AS weights_before,
         sum(source_size) OVER () AS all_sizes, sum(weight) OVER () AS all_weights
  FROM weighed WINDOW o AS (ORDER BY source_size / weight, number ROWS UNBOUNDED PRECEDING)),
rests AS (
  SELECT *, (150 * all_sizes - 200 * sizes_before)::BIGINT AS left_over, (100 * (all_weights - weights_before))::BIGINT AS rest
  FROM ordered),
level AS (
  SELECT arg_max(left_over, left_over / rest) AS left_over, arg_max(rest, left_over / rest) AS rest FROM rests),
targets AS (
  SELECT r.source, source_size, number, least(2.0::DOUBLE * source_size, (l.left_over * weight)::DOUBLE / l.rest) AS target
  FROM rests r, level l),
quotients AS (
  SELECT number, target / (2 * k + 1) AS q, k
  FROM (SELECT *, unnest(generate_series(0, floor(target / 16)::BIGINT + 21)) AS k FROM targets) WHERE target > 0),
quotas AS (
  SELECT number, count(*) AS seats
  FROM (SELECT *, row_number() OVER (ORDER BY q DESC, number, k) AS place FROM quotients)
  WHERE place <= (SELECT floor(sum(target) / 16 + 0.5) FROM targets) GROUP BY number),
dealt AS (
  SELECT s.*, t.number, t.source_size, t.target,
         ('0x' || substr(key, 1, 15))::BIGINT % greatest(1, ceil(t.source_size / 65536.0))::BIGINT AS shard
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
shards AS (
  SELECT number, shard, sum(size)::BIGINT AS shard_size, any_value(source_size) AS source_size,
         count(*) OVER (PARTITION BY number) AS n_shards
  FROM dealt GROUP BY number, shard),
shard_quotients AS (
  SELECT number, shard, seats, shard_size::DOUBLE / (2 * k + 1) AS q, k
  FROM (SELECT s.*, seats, unnest(generate_series(0, floor(shard_size::DOUBLE / source_size * seats)::BIGINT + n_shards + 1)) AS k
        FROM shards s JOIN quotas USING (number) WHERE shard_size > 0)),
shard_quotas AS (
  SELECT number, shard, 16 * count(*) AS quota
  FROM (SELECT *, row_number() OVER (PARTITION BY number ORDER BY q DESC, shard, k) AS place FROM shard_quotients)
  WHERE place <= seats GROUP BY number, shard),
placed AS (
  SELECT d.*, shard_size, least(coalesce(quota, 0), 2 * shard_size) AS quota,
         sum(size) OVER (PARTITION BY d.number, d.shard ORDER BY key, doc_id NULLS LAST, size) - size AS start
  FROM dealt d JOIN shards s ON d.number = s.number AND d.shard = s.shard
  LEFT JOIN shard_quotas q ON d.number = q.number AND d.shard = q.shard)
SELECT doc_id, size, source_size, target,
       CASE WHEN shard_size = 0 THEN 0 ELSE
         quota // shard_size * size + greatest(0, least(size, quota - quota // shard_size * shard_size - start)) END::BIGINT
         AS taken
FROM placed
""")
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that a mix of 150% of all words takes."""
    done = mixing.mixed(documents(spark, folder))
    return done.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def _digests(tokenizer, ids: list) -> list[list]:
    texts = bpe.decode(tokenizer, ids)
    return [
        [len(i) for i in ids],
        [hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids],
        [hashlib.sha256(t.encode()).hexdigest() for t in texts],
    ]


DIGESTS = {
    "n_tokens": ("bigint", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and the text they decode to, as digests."""
    done = bpe.encoded(documents(spark, folder), tokenizer_path(), finish=_digests, columns=DIGESTS)
    return done.withColumnRenamed("id", "doc_id")


@query(f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM texts WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least l ON d.doc_id = l.doc_id LEFT JOIN sizes s ON d.doc_id = s.doc_id
""")
def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents that share at least 85% of their shingles, by links."""
    found = minhash.near_groups(documents(spark, folder))
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def _left_digest(left: bytes) -> tuple:
    return (hashlib.sha256(left).hexdigest(),)


@query()
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes that strings of 400 bytes cover which start more than once."""
    done = suffix_dedup.repeated_strings(
        documents(spark, folder), finish=_left_digest, columns={"kept_sha256": ("string", pa.string())}
    )
    return done.withColumnRenamed("id", "doc_id")


@query()
def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probabilities of every text: by unigrams, and by the model."""
    return lm_scoring.scored(documents(spark, folder)).withColumnRenamed("id", "doc_id")


@query()
def op7_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every text with its personal data replaced. A production run passes a key of its own."""
    done = surrogates.with_surrogates(documents(spark, folder), key=b"key of the test tables")
    return done.withColumnRenamed("id", "doc_id")


KEEP_FROM = 0.5


@query()
def op9_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    """The probability that a document is good, by text and by metadata."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    done = cotraining.quality_scores(documents(spark, folder), labels)
    return done.select(F.col("id").alias("doc_id"), "score", (F.col("score") >= KEEP_FROM).alias("kept"))


def _crc_of_byte(i: int) -> int:
    for _ in range(8):
        i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)  # fixed value: the polynomial of CRC-32
    return i


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of a text in UTF-8."""
    table = f"[{', '.join(str(_crc_of_byte(i)) for i in range(256))}]::BIGINT[]"
    all_bytes = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda b: ('0x' || b)::BIGINT)"
    step = f"lambda c, x: xor(c // 256, ({table})[(xor(c, x) & 255) + 1])"
    return f"xor(list_reduce({all_bytes}, {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


@query(f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
aims AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
own AS (SELECT doc_id, unnest(w) AS word FROM texts),
ones AS (SELECT word, count(*) AS n FROM own GROUP BY word),
twos AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM aims) GROUP BY word),
hashed AS (
  SELECT word, {_crc32("word")} % 10000 AS bucket FROM (SELECT word FROM ones UNION SELECT word FROM twos)),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM ones JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::BIGINT AS t FROM twos JOIN hashed USING (word) GROUP BY bucket),
sums AS (
  SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + 10000 AS own, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE + 10000 AS aim),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * sums.own / ((s + 1)::DOUBLE * sums.aim)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket), sums),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM own JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM texts LEFT JOIN weights USING (doc_id)),
noised AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
placed AS (
  SELECT *, row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id) AS place,
         count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS drawn
  FROM noised)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM placed
""")
def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the documents, drawn by how much their words resemble those of the benchmark."""
    done = resampling.resampled(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return done.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


@query(f"""
WITH keyed AS (
  SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, ''))::BIGINT + 1 AS size,
         ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS tk,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS ik
  FROM documents),
groups AS (SELECT tk, sum(size)::BIGINT AS size FROM keyed GROUP BY tk),
units AS (SELECT tk, ik, sum(size)::BIGINT AS size FROM keyed GROUP BY tk, ik),
group_ends AS (SELECT *, sum(size) OVER (ORDER BY tk)::BIGINT AS upto FROM groups),
unit_ends AS (SELECT *, sum(size) OVER (ORDER BY tk, ik)::BIGINT AS upto FROM units),
total AS (
  SELECT sum(size)::BIGINT AS total, greatest(0.01::DOUBLE * (sum(size)::BIGINT / 8), max(size) / 2) AS tolerance FROM keyed),
targets AS (SELECT k, total * k / 8 AS target, tolerance FROM total, generate_series(1, 7) t(k)),
group_edges AS (
  SELECT k, CASE WHEN target - (upto - size) <= upto - target THEN upto - size ELSE upto END AS edge,
         least(target - (upto - size), upto - target) <= tolerance AS fits
  FROM targets JOIN group_ends ON upto - size < target AND target <= upto),
unit_edges AS (
  SELECT k, CASE WHEN target - (upto - size) <= upto - target THEN upto - size ELSE upto END AS edge
  FROM targets JOIN unit_ends ON upto - size < target AND target <= upto),
splitters AS (SELECT CASE WHEN fits THEN g.edge ELSE u.edge END AS edge FROM group_edges g JOIN unit_edges u USING (k)),
dealt AS (
  SELECT tk, ik, (SELECT count(*) FROM splitters WHERE edge <= u.upto - u.size)::INTEGER AS shard FROM unit_ends u)
SELECT doc_id, size, {_crc32("text")} AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY tk, ik) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM keyed JOIN dealt USING (tk, ik)
""")
def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Eight shards of near equal bytes; equal texts lie together."""
    done = sharding.sharded(documents(spark, folder))
    return done.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit(sharding.LAW).alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def _groups_digest(groups: Iterable[bytes]) -> str:
    digest, parts = hashlib.sha256(), iter(groups)
    while some := b"".join(itertools.islice(parts, 10_000)):
        digest.update(some)
    return digest.hexdigest()


@query()
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of two tokenizers over the same bytes: groups with common ends, links, and how common the links are."""
    done = alignment.aligned(
        documents(spark, folder), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"),
        finish=_groups_digest, kind=("string", pa.string()),
    )
    return done.withColumn("groups_sha256", F.coalesce("groups", F.lit(""))).withColumnRenamed("id", "doc_id").drop("groups")
