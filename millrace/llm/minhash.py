"""Near duplicates by circulant MinHash.

A document is the set of its word shingles. Two permutations make the whole signature: the first scatters the shingles
over 32 bits, the second is shifted by one place for each further coordinate. Bands of coordinates put documents that
may be alike into buckets. Documents with equal sets are one node from the beginning.

Each bucket has a centre, the member that shares most buckets with others; copies of one text thus have the same centre
in most of their buckets. All members of a centre's buckets are its star, and two documents that share a bucket are in
one star at least. A star of bounded size is a task: its members are compared on their full sets, by counting shingles
in common for all of them at once, and only the edges of a spanning forest of the links come out. A larger star is dealt
out in parts. Each part is compared within itself and with the centre; then the members that are not yet in the centre's
component are held against all other parts. Members of the centre's component need not be compared with each other, so
a group of near copies costs as much as it has members, besides those that are not linked to its centre.

At the default 40 bands of 5 rows two sets of similarity 0.85 share no bucket with a probability of 7e-11, and of
similarity 0.8 with 1.3e-7.

Null or empty texts, and texts of white space only, have no shingles and are linked with nothing. A text of fewer words
than a shingle is a single shingle. Rows that share an identifier and have different sets are nodes of their own. A row
with a null identifier is linked with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, stored
from millrace.llm.components import components

WORDS = 5
PERCENT = 85
BANDS = 40
ROWS = 5
BATCH = "4m"  # of texts, to a Python worker at a time
CHUNK = 1 << 15  # shingles that are permuted at a time
STAR = 512  # members of a star, or of a part of one
STAR_SHINGLES = 1_000_000  # of a star's members together
FEW = 12  # members that are compared one by one
COMMON = 16  # holders of a shingle from which on holders are counted by a matrix product
COLUMNS = 2048

# Odd multipliers of the mixing functions.
M64 = np.uint64(0x9E3779B97F4A7C15)
N64 = np.uint64(0xBF58476D1CE4E5B9)
M32 = np.uint32(0x85EBCA6B)
N32 = np.uint32(0xC2B2AE35)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * N64
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    found = (text or "").encode().lower().split()  # of bytes: A-Z, and ASCII white space
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    total = np.full(len(found) - width + 1, width, np.uint64)
    for i in range(width):
        total = mix64(total * M64 + hashes[i : len(found) - width + 1 + i])
    return np.unique(total)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """A row of `coordinates` minima for each set, none of which is empty."""
    out = np.empty((len(sets), coordinates), np.uint32)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (size == 0 or size + len(sets[end]) <= CHUNK):
            size += len(sets[end])
            end += 1
        # The first permutation, on the upper half of well-mixed hashes.
        first = (mix64(np.concatenate(sets[at:end]) * M64) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *[len(s) for s in sets[at : end - 1]]])
        x, y = np.empty_like(first), np.empty_like(first)
        for k in range(coordinates):
            np.subtract(first, np.uint32(k), out=x)  # the circular shift
            np.right_shift(x, np.uint32(16), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, M32, out=x)
            np.right_shift(x, np.uint32(13), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, N32, out=x)
            np.right_shift(x, np.uint32(16), out=y)
            np.bitwise_xor(x, y, out=x)
            out[at:end, k] = np.minimum.reduceat(x, starts)
        at = end
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of each row."""
    parts = signature.reshape(len(signature), bands, -1).astype(np.uint64)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(1), parts.shape[:2]).copy()
    for i in range(parts.shape[2]):
        keys = mix64(keys * M64 + parts[:, :, i])
    return keys


PREPARED_SQL = "id bigint, tag bigint, n_shingles bigint, set_hash binary, bands array<bigint>"


def _prepared(batches: Iterator[pa.RecordBatch], words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            sets = [shingles(text, words) for text in batch.column("text").to_pylist()]
            full = [s for s in sets if len(s)]
            keys = band_keys(signatures(full, bands * rows), bands) if full else np.empty((0, bands), np.uint64)
            ends = np.cumsum([0, *[bands if len(s) else 0 for s in sets]])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("tag"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel().view(np.int64))),
                ],
                names=["id", "tag", "n_shingles", "set_hash", "bands"],
            )


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements any two of the sets have in common."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    _, element, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.zeros((n, n), np.float32)
    column = np.cumsum(holders >= COMMON) - 1
    often = holders[element] >= COMMON
    rows, columns = owner[often], column[element[often]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    for first in range(0, int(columns[-1]) + 1 if len(columns) else 0, COLUMNS):
        low, high = np.searchsorted(columns, [first, first + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[rows[low:high], columns[low:high] - first] = 1
        out += part @ part.T
    seldom = (holders[element] < COMMON) & (holders[element] > 1)
    rows, element = owner[seldom], element[seldom]
    order = np.argsort(element, kind="stable")
    rows, element = rows[order], element[order]
    pairs = np.zeros(n * n)
    for step in range(1, COMMON - 1):
        same = np.flatnonzero(element[step:] == element[:-step])
        if not len(same):
            break
        pairs += np.bincount(rows[same] * n + rows[same + step], minlength=n * n)
    pairs = pairs.reshape(n, n)
    return out + pairs + pairs.T


def spanning_links(nodes: list[int], sets: list[np.ndarray], percent: int, outside: list[bool] | None = None) -> list[tuple[int, int]]:
    """Edges that connect what links connect; of two nodes that are not `outside` no link is looked for."""
    root = list(range(len(nodes)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def linked() -> Iterator[tuple[int, int]]:
        sizes = np.array([len(x) for x in sets])
        if len(nodes) > FEW:
            common = common_counts(sets)
            links = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
            yield from zip(*np.nonzero(np.triu(links, 1)))
            return
        for i in range(len(nodes)):
            for j in range(i + 1, len(nodes)):
                small, large = sorted((len(sets[i]), len(sets[j])))
                if 100 * small >= percent * large and find(i) != find(j):
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * common >= percent * (small + large - common):
                        yield i, j

    out = []
    for i, j in linked():
        if outside and not (outside[i] or outside[j]):
            continue
        x, y = find(int(i)), find(int(j))
        if x != y:
            root[y] = x
            out.append((nodes[int(i)], nodes[int(j)]))
    return out


def _stars(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links (u, v) of stars or parts of them; rows of one `task` come one after another."""
    unpack = zstandard.ZstdDecompressor()

    def links(rows: list[tuple]) -> pa.RecordBatch:
        # A node that is there twice, as centre and as member or in repeated rows, is compared once.
        once = {node: (packed, outside) for _, node, packed, outside in rows}
        sets = [shingles(unpack.decompress(packed).decode(), words) for packed, _ in once.values()]
        found = spanning_links(list(once), sets, percent, [o for _, o in once.values()])
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[batch.column(n).to_pylist() for n in ("task", "node", "packed", "outside")]):
            if held and row[0] != held[0][0]:
                yield links(held)
                held = []
            held.append(row)
    if held:
        yield links(held)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [pack.compress(t.encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(packed, pa.binary())], names=["node", "packed"])


def _compared(tasks: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links among the rows (task, node, outside) of each task."""
    return (
        tasks.join(texts, "node")
        .select("task", "node", "packed", "outside")
        .repartition("task")
        .sortWithinPartitions("task")
        .mapInArrow(partial(_stars, words=words, percent=percent), "u bigint, v bigint")
    )


def _across_parts(members: DataFrame) -> DataFrame:
    """Tasks that hold every member outside its centre's component against all other members of its star.

    `members` has (centre, node, n, outside). Outside members make parts of their own, and a task is a pair of parts of
    which one at least is of these.
    """
    parts = lambda n, w: F.ceil(F.greatest(n / STAR, w / STAR_SHINGLES))
    counted = members.groupBy("centre").agg(
        F.sum(F.col("outside").cast("int")).alias("n_out"), F.sum(F.when(F.col("outside"), F.col("n")).otherwise(0)).alias("w_out"),
        F.sum((~F.col("outside")).cast("int")).alias("n_in"), F.sum(F.when(F.col("outside"), 0).otherwise(F.col("n"))).alias("w_in"),
    ).where("n_out > 0").select(
        "centre", parts(F.col("n_out"), F.col("w_out")).alias("outer"), parts(F.col("n_in"), F.col("w_in")).alias("inner")
    )
    spread = members.join(counted, "centre").withColumn(
        "own", F.when(F.col("outside"), F.pmod(F.xxhash64("node"), F.col("outer")))
        .otherwise(F.col("outer") + F.pmod(F.xxhash64("node"), F.col("inner")))
    )
    # An outside part meets every part, another one only the outside parts.
    others = F.sequence(F.lit(0).cast("bigint"), F.when(F.col("outside"), F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1)
    return spread.select("centre", "node", "outside", "own", F.explode(others).alias("other")).select(
        F.xxhash64("centre", F.least("own", "other"), F.greatest("own", "other")).alias("task"), "node", "outside"
    )


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Rows (id, tag, n_shingles, component, component_tag) of every row of `docs`.

    Documents are linked if they share at least `percent` of all shingles of both. `component` is the smallest
    identifier that links lead to. `tag` tells texts under one identifier apart, `component_tag` that of `component`.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    prepared = stored(
        texts.mapInArrow(partial(_prepared, words=words, bands=bands, rows=rows), PREPARED_SQL), "prepared", BATCH
    ).df
    own = F.struct("id", "tag")
    # An identifier that more than one class begins with names none of them; such classes go by their sets.
    first_of = stored(
        prepared.where("n_shingles > 0 and id is not null")
        .groupBy("set_hash")
        .agg(F.min(own).alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
        .select("set_hash", F.col("first.id").alias("id"), F.col("first.tag").alias("tag"), "n", "bands"),
        "classes",
    ).df
    shared = first_of.groupBy(F.col("id").alias("shared")).agg(F.count("*").alias("times")).where("times > 1").select("shared")
    classes = first_of.join(shared, first_of["id"] == shared["shared"], "left").withColumn(
        "node", F.when(F.col("shared").isNull(), F.col("id")).otherwise(F.xxhash64("set_hash", F.lit(1)))
    ).drop("shared")

    # Buckets with at least two members, and how many other members each node meets.
    exploded = classes.select("node", "n", F.explode("bands").alias("bucket"))
    sizes = exploded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(exploded.join(sizes, "bucket"), "buckets")
    meets = members.df.groupBy("node").agg(F.sum("size").alias("meets"))
    needed = meets.select("node").join(classes.select("node", F.col("id").alias("own_id"), F.col("tag").alias("own_tag")), "node")
    compared = stored(
        texts.join(needed, (texts["id"] == needed["own_id"]) & (texts["tag"] == needed["own_tag"])).select("node", "text")
        .mapInArrow(_packed, "node bigint, packed binary"),
        "compared", BATCH,
    )
    # A bucket's centre, and the stars of all centres.
    met = members.df.join(meets, "node")
    best = met.groupBy("bucket").agg(F.max(F.struct("meets", (-F.col("node")).alias("minus"), "n")).alias("best")).select(
        "bucket", (-F.col("best.minus")).alias("centre"), F.col("best.n").alias("centre_n")
    )
    apart = (F.col("size") == 2) & (100 * F.least("n", "centre_n") < percent * F.greatest("n", "centre_n"))
    star = (
        members.df.join(best, "bucket").where((F.col("node") != F.col("centre")) & ~apart)
        .select("centre", "node", "n").distinct()
    )
    star = stored(star, "stars")
    discard(spark, members)
    sizes = star.df.groupBy("centre").agg(
        F.ceil(F.greatest(F.count("*") / STAR, F.sum("n") / STAR_SHINGLES)).alias("parts")
    )
    parted = stored(star.df.join(sizes, "centre"), "parts")
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    outside = F.lit(True).alias("outside")
    each = parted.df.select(F.xxhash64("centre", part).alias("task"), "node", outside)
    centres = sizes.select("centre", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    centres = centres.select(F.xxhash64("centre", "part").alias("task"), F.col("centre").alias("node"), outside)
    links = stored(_compared(each.union(centres), compared.df, words, percent), "links").df
    settled = components(links)

    large = parted.df.where("parts > 1").select("centre", "node", "n")
    if not large.isEmpty():
        of_centre = settled.df.select(F.col("node").alias("centre"), F.col("component").alias("of_centre"))
        labelled = large.join(of_centre, "centre", "left").join(settled.df, "node", "left").select(
            "centre", "node", "n",
            (F.coalesce("component", "node") != F.coalesce("of_centre", "centre")).alias("outside"),
        )
        more = _compared(_across_parts(stored(labelled, "labelled").df), compared.df, words, percent)
        more = stored(more, "more-links").df
        if not more.isEmpty():
            # What is linked already goes on as one edge a node.
            first = settled
            settled = components(first.df.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))
            discard(spark, first)
    discard(spark, star, parted, compared)

    joined = stored(
        classes.select("set_hash", "node", "id", "tag").join(settled.df, "node", "left")
        .select("set_hash", F.struct("id", "tag").alias("own"), F.coalesce("component", "node").alias("of")),
        "joined",
    ).df
    # A component is known by the smallest identifier in it.
    least = joined.groupBy("of").agg(F.min("own").alias("least"))
    components_of = joined.join(least, "of").select("set_hash", "least")
    linked = (F.col("n_shingles") > 0) & F.col("id").isNotNull()
    return prepared.join(components_of, "set_hash", "left").select(
        "id", "tag", "n_shingles",
        F.when(linked, F.col("least.id")).otherwise(F.col("id")).alias("component"),
        F.when(linked, F.col("least.tag")).otherwise(F.col("tag")).alias("component_tag"),
    )
