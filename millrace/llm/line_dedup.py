"""Repeated lines across documents, as a bitmap per document.

Each line's key is hashed; the hashes are dealt out by range and sorted by document and position, so the first holder
of a key comes first in its stretch. A stretch is one key within a band of identifiers: a key that a third of all
documents hold covers many stretches, which go to different tasks. The heads of the stretches, one per key and band,
then tell which band holds the key first. What comes back is a sparse bitmap of dropped lines per document (64 lines a
word, words without a dropped line left out); the text itself is not shuffled to find it.

Rows that share an identifier count as one document. A null identifier comes after all others. Null text is one empty
line. Documents without a dropped line have no bitmap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS, ascii_lower, discard, id_after, stored

BAND_BITS = 12  # identifiers of a band: 2 ** BAND_BITS
LEAST_CHARS = 10
HASH_HEX = 32  # 128 bits


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with one identifier and different texts keep their own bitmaps."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def dropped_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS
) -> DataFrame:
    """Rows (id, tag, n_dropped, dropped): the sparse bitmap as an array of (word, bits), in order of words.

    `tag` tells texts under one identifier apart. Line p is bit p % 64 of word p / 64.
    """
    spark = docs.sparkSession
    lines = _tagged(docs, id_col, text_col).select("id", "tag", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keys = lines.select("id", "tag", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= least_chars)
    hashed = stored(
        keys.select("id", "tag", "pos", F.unhex(F.substring(F.sha2("key", 256), 1, HASH_HEX)).alias("hash")), "lines"
    )

    # Rows without an identifier are dealt out by their text.
    band = F.coalesce(F.shiftright("id", BAND_BITS), -1 - F.pmod("tag", F.lit(1 << BAND_BITS)))
    stretch = Window.partitionBy("hash", "band").orderBy(F.asc_nulls_last("id"), "tag", "pos")
    streamed = stored(
        hashed.df.withColumn("band", band)
        .repartitionByRange("hash", "band")  # the window needs no other exchange
        .withColumn("head", F.first("id").over(stretch))
        .withColumn("at", F.row_number().over(stretch)),
        "streamed",
    )
    discard(spark, hashed)

    # Keys that are found in several bands, and their first holder. Others are settled within their stretch.
    heads = streamed.df.where("at = 1").groupBy("hash").agg(F.min("head").alias("first"), F.count("*").alias("bands"))
    several = heads.where("bands > 1").drop("bands")
    in_band = streamed.df.where(id_after(F.col("id"), F.col("head")))
    rest = streamed.df.where(F.col("id").eqNullSafe(F.col("head")))
    across = rest.join(several, "hash").where(id_after(F.col("id"), F.col("first")))
    dropped = in_band.select("id", "tag", "pos").union(across.select("id", "tag", "pos"))

    bits = dropped.groupBy("id", "tag", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("pos") % 64)).alias("bits")
    )
    return bits.groupBy("id", "tag").agg(
        F.sum(F.bit_count("bits")).alias("n_dropped"), F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("dropped")
    )


def kept_lines(lines: Column, dropped: Column) -> Column:
    """The lines whose bit is not set in a bitmap; all lines under a null bitmap."""
    by_word = F.map_from_entries(dropped)
    words = F.transform(F.sequence(F.lit(0), F.element_at(dropped, -1)["word"]), lambda w: F.coalesce(by_word[w], F.lit(0)))

    def kept(bitmap: Column) -> Column:
        def stays(_, i):
            word = F.get(bitmap, F.shiftright(i, 6))
            return F.coalesce(F.call_function("shiftright", word, i % 64).bitwiseAND(1) == 0, F.lit(True))

        return F.filter(lines, stays)

    # transform() over a single element evaluates the bitmap once for all lines.
    return F.coalesce(F.transform(F.array(words), kept)[0], lines)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """A row for each row of `docs`: id, n_lines, n_dropped, text (what is left), dropped (the bitmap, or null)."""
    bitmaps = dropped_lines(docs, id_col, text_col, least_chars)
    here = _tagged(docs, id_col, text_col)
    same = here["id"].eqNullSafe(bitmaps["id"]) & (here["tag"] == bitmaps["tag"])
    lines = lines_of(here["text"])
    return here.join(bitmaps, same, "left").select(
        here["id"],
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), here["text"])
        .otherwise(F.array_join(kept_lines(lines, F.col("dropped")), "\n"))
        .alias("text"),
        "dropped",
    )
