"""A corpus from raw documents: quality rules, exact and near duplicates, a mix of sources, and token ids.

STAGES lists (name, function). Each function takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents.

Nulls, empty texts, repeated rows and empty tables: see the operators. Columns beyond those that a stage needs are
carried along under any name. Rows with null identifiers pass through every stage on their own merits.
"""

from __future__ import annotations

import os
import sys

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.llm import bpe, exact_dedup, minhash, mixing, quality_rules  # noqa: E402
from millrace.llm.common import documents, stored  # noqa: E402
from millrace.llm.queries import tokenizer_path  # noqa: E402
from millrace.operators.ordered import running  # noqa: E402
from millrace.session import prepare  # noqa: E402

NEAR_PERCENT = 80


def _tagged(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """`docs` under positional names, with _id and _tag, by which decisions find their rows again; and the true names."""
    names = docs.columns
    renamed = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = F.coalesce(renamed[f"c{names.index('text')}"], F.lit(""))
    return renamed.withColumns({
        "_id": renamed[f"c{names.index('doc_id')}"].cast("bigint"), "_tag": F.xxhash64(text),
    }), names


def _named(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])


def _joined(docs: DataFrame, decisions: DataFrame, how: str, more: list[str] = []) -> DataFrame:  # noqa: B006
    on = docs["_id"].eqNullSafe(decisions["id"]) & (docs["_tag"] == decisions["tag"])
    for c in more:
        on = on & docs[c].eqNullSafe(decisions["host"])
    return docs.join(decisions, on, how)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, of hosts that pass."""
    prepare(spark)
    rows, names = _tagged(docs)
    kept = quality_rules.judged(docs).where("kept").select("id", "tag", "host").distinct()
    return _named(_joined(rows, kept, "left_semi", [f"c{names.index('source')}"]), names)


def keep_one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest identifier of each text."""
    prepare(spark)
    return exact_dedup.exact_dedup(docs)


def keep_one_of_alike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest identifier."""
    prepare(spark)
    rows, names = _tagged(docs)
    groups = minhash.near_groups(docs, percent=NEAR_PERCENT)
    # Texts that share an identifier are told apart by their tags; a null identifier is no document's.
    first = groups.where("id = component and tag = component_tag").select("id", "tag").distinct()
    none = groups.where("id is null").select("id", "tag").distinct()
    kept = stored(first.union(none), "kept").df
    alike = _joined(rows, kept, "left_semi")
    once = alike.where("_id is not null").groupBy("_id", "_tag").agg(F.min(F.struct(*[f"c{i}" for i in range(len(names))])).alias("row"))
    return _named(once.select("row.*").union(alike.where("_id is null").drop("_id", "_tag")), names)


# Parts of a document, as whole numbers.
PARTS = 1 << 40


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them: none, once or twice.

    Documents that are taken in part are rounded along a running total over their source, from the longest to the
    shortest, so that a source's words come within its longest such document of what the mix takes, however long the
    documents are.
    """
    prepare(spark)
    rows, names = _tagged(docs)
    taken = stored(
        mixing.mixed(docs).where("size > 0").select("id", "tag", F.col("source").alias("host"), "size", "taken")
        # Repeated rows are taken alike, as often as the first of them.
        .groupBy("id", "tag", "host").agg(F.max("size").alias("size"), F.max("taken").alias("taken")), "taken",
    ).df
    whole = F.floor(F.col("taken") / F.col("size"))
    part = F.floor((F.col("taken") - whole * F.col("size")) / F.col("size") * PARTS)
    split = taken.select("id", "tag", "host", "size", whole.alias("times"), part.alias("part"))
    order = [F.desc("size"), F.asc_nulls_last("id"), F.col("tag")]
    summed = running(split.where("part > 0"), order, {"upto": F.col("part")}, ["host"])
    step = lambda c: F.floor((c + PARTS // 2) / PARTS)
    rounded = summed.withColumn("times", F.col("times") + step(F.col("upto")) - step(F.col("upto") - F.col("part")))
    times = split.where("part = 0").select("id", "tag", "host", "times").union(rounded.select("id", "tag", "host", "times"))
    found = _joined(rows, times.where("times > 0"), "inner", [f"c{names.index('source')}"])
    return _named(found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))), names)


IDS = {"ids": ("array<bigint>", pa.list_(pa.int64())), "n_tokens": ("bigint", pa.int64())}


def _ids(tokenizer, ids: list) -> list[list]:
    return [ids, [len(i) for i in ids]]


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: doc_id, ids, n_tokens."""
    prepare(spark)
    return bpe.encoded(docs, tokenizer_path(), finish=_ids, columns=IDS).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", keep_good),
    ("exact_dedup", keep_one_of_equal),
    ("near_dedup", keep_one_of_alike),
    ("mixing", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the table of documents."""
    docs = documents(prepare(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)


# Shares of shingles over chains of near duplicates, and a tokenizer's merges, are beyond SQL.
ORACLE_SQL = None
