"""Mixing sources to target weights by Sainte-Lague apportionment.

Words are dealt in blocks of equal size. Sources get blocks by highest quotients target / (2 k + 1); a source's blocks
go to its shards the same way, so each shard has an integer quota. In a shard, documents stand in a seeded order and the
quota takes blocks from the start, going round again when a shard is taken more than once. A shard holds a bounded
number of words, so a hot source is many shards, and no window sees more than one shard.

The quotients are not listed: with the divisor votes / seats every unit's number of blocks is known up to a few, and
only the quotients around that place are ranked.

Null and empty texts have size 0 and are taken 0 times. A null source comes last. Repeated rows are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.llm.common import WORD, stored
from millrace.operators.ordered import numbered, running

WEIGHTS = (3, 1, 2)
PERCENT = 150
MOST = 2
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 16
SEED = "mix-1"


def with_targets(sources: DataFrame, weights: tuple[int, ...], percent: int, most: int) -> DataFrame:
    """`sources` (source, source_size) with number, weight, target and part, which is the same for all.

    Sources are weighed in order. Each gets `percent` of all sizes by weight, at most `most` times its own size; what is
    left over is shared again. In the order of size to weight the full sources come first, so the level at which the
    others stand is the largest that any beginning of this order leaves.
    """
    number = F.col("number")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((number - 1) % len(weights) + 1).cast("int"))
    weighed = numbered(sources, [F.asc_nulls_last("source")], name="number").withColumn("weight", weight)
    by_room = [F.col("source_size") / F.col("weight"), number]
    summed = stored(running(weighed, by_room, {"sizes": F.col("source_size"), "weights": F.col("weight")}), "sources").df
    all_sizes, all_weights = summed.agg(F.sum("source_size"), F.sum("weight")).first()
    all_sizes, all_weights = all_sizes or 0, all_weights or 1
    # In hundredths, as whole numbers: what is left for this source and those after it, and their weight.
    left = F.lit(percent * all_sizes) - 100 * most * (F.col("sizes") - F.col("source_size"))
    rest = 100 * (F.lit(all_weights) - F.col("weights") + F.col("weight"))
    level = summed.select(left.alias("left"), rest.alias("rest")).agg(
        F.max_by(F.struct("left", "rest"), F.col("left") / F.col("rest")).alias("level")
    ).first()["level"] or (0, 1)
    share = F.lit(level[0]).cast("bigint") * F.col("weight") / F.lit(level[1]).cast("bigint")
    return summed.select(
        F.lit(0).alias("part"), "source", "source_size", "number", "weight",
        F.least((most * F.col("source_size")).cast("double"), share.cast("double")).alias("target"),
    )


def sainte_lague(units: DataFrame) -> DataFrame:
    """`units` (part, unit, votes, all_votes, seats, n_units) with `blocks`; the blocks of a part add up to its seats.

    `all_votes`, `seats` and `n_units` are those of the part.
    """
    share = F.col("votes") / F.col("all_votes")
    begun = units.withColumn(
        "begun", F.when(F.col("all_votes") > 0, F.floor(share * F.col("seats") + 0.5)).otherwise(0).cast("bigint")
    )
    lack = begun.groupBy("part").agg((F.first("seats") - F.sum("begun")).alias("lack"))
    begun = begun.join(lack, "part")
    # A unit moves by no more than its share of what is lacking and of what rounding has moved, and one.
    moves = F.ceil((F.abs("lack") + F.col("n_units")) * share) + 1
    near = begun.where("lack != 0 and votes > 0").select(
        "part", "unit", "votes", "begun", "lack", F.explode(F.sequence(F.lit(0).cast("bigint"), moves)).alias("j")
    )
    gains = F.col("lack") > 0
    k = F.when(gains, F.col("begun") + F.col("j")).otherwise(F.col("begun") - 1 - F.col("j"))
    quotients = near.withColumn("k", k).where("k >= 0").withColumn("quotient", F.col("votes") / (2 * F.col("k") + 1))
    rank = F.when(gains, -F.col("quotient")).otherwise(F.col("quotient"))
    moved = (
        numbered(quotients, [rank, F.col("unit"), F.col("k")], ["part"], "place")
        .where(F.col("place") <= F.abs("lack"))
        .groupBy("part", "unit")
        .agg(F.sum(F.signum("lack")).cast("bigint").alias("moved"))
    )
    return begun.join(moved, ["part", "unit"], "left").select(
        *units.columns, (F.col("begun") + F.coalesce("moved", F.lit(0))).alias("blocks")
    )


def _taken(size: Column, start: Column, shard_size: Column, quota: Column, most: int) -> Column:
    """Words of a document: whole rounds through the shard, and what the last round reaches."""
    quota = F.least(quota, most * shard_size)
    rounds = F.when(shard_size > 0, F.floor(quota / shard_size)).otherwise(0)
    reached = F.greatest(F.lit(0), F.least(size, quota - rounds * shard_size - start))
    return (rounds * size + reached).cast("bigint")


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    percent: int = PERCENT,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """Rows (id, tag, source, size, source_size, target, taken) of every row of `docs`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = stored(
        docs.select(
            F.col(id_col).cast("bigint").alias("id"),
            F.xxhash64(text).alias("tag"),
            F.col(source_col).alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
        ),
        "sized",
    ).df
    sources = stored(
        with_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, percent, most), "targets"
    ).df
    wanted, n_sources = sources.agg(F.sum("target"), F.count("*")).first()
    seats = int((wanted or 0.0) / block_words + 0.5)
    quotas = stored(
        sainte_lague(
            sources.select(
                "part", F.col("number").alias("unit"), F.col("target").alias("votes"),
                F.lit(wanted or 0.0).alias("all_votes"), F.lit(seats).cast("bigint").alias("seats"),
                F.lit(n_sources).alias("n_units"),
            )
        ).select(F.col("unit").alias("number"), F.col("blocks").alias("source_blocks")),
        "quotas",
    ).df
    known = stored(sources.join(quotas, "number").withColumnRenamed("source", "known_source"), "known").df

    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    n_shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))
    dealt = sized.join(known, sized["source"].eqNullSafe(known["known_source"])).select(
        "id", "tag", "source", "size", "source_size", "target", "number", "source_blocks", key.alias("key")
    )
    dealt = dealt.withColumn("shard", F.conv(F.substring("key", 1, 15), 16, 10).cast("bigint") % n_shards)
    shards = stored(
        dealt.groupBy("number", "shard").agg(
            F.sum("size").alias("shard_size"), F.first("source_size").alias("all_size"), F.first("source_blocks").alias("seats")
        ),
        "shards",
    ).df
    n_units = shards.groupBy("number").agg(F.count("*").alias("n_units"))
    apportioned = sainte_lague(
        shards.join(n_units, "number").select(
            F.col("number").alias("part"), F.col("shard").alias("unit"), F.col("shard_size").cast("double").alias("votes"),
            F.col("all_size").cast("double").alias("all_votes"), "seats", "n_units",
        )
    ).select(
        F.col("part").alias("number"), F.col("unit").alias("shard"),
        F.col("votes").cast("bigint").alias("shard_size"), (F.col("blocks") * block_words).alias("quota"),
    )
    apportioned = stored(apportioned, "apportioned").df
    before = (
        Window.partitionBy("number", "shard").orderBy("key", F.asc_nulls_last("id"), "size", "tag")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = dealt.join(apportioned, ["number", "shard"]).withColumn(
        "start", F.coalesce(F.sum("size").over(before), F.lit(0))
    )
    taken = _taken(F.col("size"), F.col("start"), F.col("shard_size"), F.col("quota"), most)
    return placed.select("id", "tag", "source", "size", "source_size", "target", taken.alias("taken"))
