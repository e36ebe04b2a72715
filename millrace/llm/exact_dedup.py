"""Exact duplicates by sorting documents by content.

Sampled splitters deal the texts out by range, so equal texts lie next to each other after each slice is sorted. The
sort key is the beginning of the text, its SHA-256 and the identifier: splitters stay short whatever the texts' length,
and a text with any number of copies covers several slices. A slice is read as a stream; neighbours with equal digests
are compared in full. A group that touches a slice's edge may go on in the next slice; these groups, two a slice at
most, are put together afterwards.

Null texts count as empty. Rows with a null identifier come last in their group; a row is kept from every group, also
from one without any identifier. Of repeated rows with one identifier a single row is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

SPLITTER_CHARS = 32
BATCH_ROWS = 2000
BATCH = "4m"  # of texts, to a Python worker at a time


def _runs(batches: Iterator[pa.RecordBatch], emit: Callable[[list, int, bool, bool], Iterator]) -> Iterator:
    """Call `emit(rows, slice, is first run, is last run)` for each run of equal texts in a sorted slice.

    A row is (sha, text, rest). Of the rows after the first of a run the text is dropped.
    """
    at = TaskContext.get().partitionId()
    run: list = []
    first = True
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for sha, text, *rest in zip(*columns):
            if run and (run[0][0] != sha or run[0][1] != text):
                yield from emit(run, at, first, False)
                first, run = False, []
            run.append((sha, None if run else text, rest))
    if run:
        yield from emit(run, at, first, True)


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


GROUPS = pa.schema([
    ("id", pa.int64()), ("sha", pa.string()), ("keep", pa.int64()), ("size", pa.int64()), ("head", pa.bool_()),
    ("edge", pa.bool_()), ("slice", pa.int32()),
])
GROUPS_SQL = "id bigint, sha string, keep bigint, size bigint, head boolean, edge boolean, slice int"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(run, at, first, last):
        keep = run[0][2][0]
        for i, (sha, _, (own,)) in enumerate(run):
            yield own, sha, keep, len(run), i == 0, first or last, at

    yield from _batched(_runs(batches, emit), GROUPS)


def _content_sorted(docs: DataFrame, text: Column, id_col: str, largest: bool, columns: list[Column]) -> DataFrame:
    """Columns _sha, _text and `columns`, dealt out and sorted by content."""
    order = F.col("_id").desc_nulls_last() if largest else F.col("_id").asc_nulls_last()
    keyed = docs.select(
        F.sha2(text, 256).alias("_sha"), text.alias("_text"), F.col(id_col).cast("bigint").alias("_id"), *columns
    )
    by = [F.substring("_text", 1, SPLITTER_CHARS), F.col("_sha"), order]
    return keyed.repartitionByRange(*by).sortWithinPartitions(*by)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
    largest: bool = False,
) -> DataFrame:
    """A row for each row of `docs`: id, keep_id, group_size, kept, sha (hex, of the normalised text in UTF-8).

    The row with the smallest identifier is kept, or with the largest.
    """
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    ordered = _content_sorted(docs, text, id_col, largest, []).select("_sha", "_text", "_id")
    members = stored(ordered.mapInArrow(_members, GROUPS_SQL), "exact").df
    # Only groups at the edges of slices may go on; the others are whole.
    edges = members.where("edge and head").groupBy("sha").agg(
        F.min("slice").alias("first_slice"), F.min_by("keep", "slice").alias("all_keep"), F.sum("size").alias("all_size")
    )
    at_edge = members.where("edge").join(edges, "sha").select(
        "id", F.col("all_keep").alias("keep_id"), F.col("all_size").alias("group_size"),
        (F.col("head") & (F.col("slice") == F.col("first_slice"))).alias("kept"), "sha",
    )
    inner = members.where("not edge").select(
        "id", F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), F.col("head").alias("kept"), "sha"
    )
    return inner.union(at_edge)


def _first_rows(batch: pa.RecordBatch, before: tuple | None) -> np.ndarray:
    """Places of the rows whose first two columns are not those of the row before; `before` has them of an earlier batch's last."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = before != tuple(c[0].as_py() for c in batch.columns[:2])
    for column in batch.columns[:2]:
        a, b = column.slice(0, batch.num_rows - 1), column.slice(1)
        differs = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        new[1:] |= differs.to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    largest: bool = False,
) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = [f"c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    at = docs.columns.index(text_col)
    plain = renamed[names[at]]
    text = F.coalesce(plain, F.lit(""))
    text = normalise(text) if normalise else text
    rest = [renamed[c] for i, c in enumerate(names) if i != at]
    # Without a normalisation the compared text is the text itself and travels once; a flag tells null from empty.
    extra = [plain] if normalise else [plain.isNull().alias("_null")]
    ordered = _content_sorted(renamed, text, names[docs.columns.index(id_col)], largest, [*rest, *extra]).drop("_id")
    schema = ordered.selectExpr("*", "false as _edge", "0 as _slice").schema

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        held, before, first = None, None, True

        def flagged(rows, edge):
            n = rows.num_rows
            return pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([edge] * n, pa.bool_()), pa.array([at] * n, pa.int32())],
                names=[*rows.schema.names, "_edge", "_slice"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            new = _first_rows(batch, before).tolist()
            before = tuple(c[batch.num_rows - 1].as_py() for c in batch.columns[:2])
            if not new:
                continue
            if held is not None:
                yield flagged(held, first)
                first = False
            *inner, last = new
            if inner and first:
                yield flagged(batch.slice(inner.pop(0), 1), True)
                first = False
            if inner:
                yield flagged(batch.take(pa.array(inner)), False)
            held = batch.slice(last, 1)
        if held is not None:
            yield flagged(held, True)

    kept = stored(ordered.mapInArrow(heads, schema), "exact-rows", BATCH).df
    # The first row of every slice and its last group: two rows a slice at most, the only ones that are joined.
    later = kept.where("_edge").groupBy("_sha").agg(F.min("_slice").alias("_first"))
    at_edge = kept.where("_edge").join(later, "_sha").where("_slice = _first").select(*kept.columns)
    whole = kept.where("not _edge").union(at_edge)
    back = F.when(~F.col("_null"), F.col("_text")) if not normalise else F.col(names[at])
    return whole.select(*[(back if i == at else F.col(c)).alias(docs.columns[i]) for i, c in enumerate(names)])
