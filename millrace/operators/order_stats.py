"""Exact order statistics that never bring a column's values together in one task.

Each round proposes two cut points around the wanted rank from an approximate quantile, or for
text from a sample of the values, then counts rows exactly on either side of them, so the cut
points only decide how fast the search narrows and never what it returns. A round reads the data
but shuffles one row per task. The last few rows are sorted once they fit `SMALL`.
"""

from __future__ import annotations

import functools
import math
import os
from collections.abc import Iterable
from dataclasses import dataclass, replace
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.predicates import literal

SMALL = 100_000
ACCURACY = 10_000
SAMPLE = 4_000  # rows, on average, that cut points of text are taken from
PREFIX = 64  # characters of each that come to the driver
SMALL_TEXTS = 5_000  # texts may be long, so fewer of them are sorted in one place
LAST = "\U0010ffff"


@dataclass(frozen=True)
class _Interval:
    """Rows of a column strictly between `low` and `high`, `inside` of them; `below` are <= low."""

    column: str
    data_type: T.DataType
    inside: int
    below: int = 0
    low: Any = None
    high: Any = None

    def lit(self, value) -> Column:
        return literal(value, self.data_type)

    def holds(self) -> Column:
        c = F.col(self.column)
        cond = _present(c, self.data_type)
        if self.low is not None:
            cond = cond & (c > self.lit(self.low))
        if self.high is not None:
            cond = cond & (c < self.lit(self.high))
        return cond


# Wanted ranks by the interval that holds them.
Searches = dict[_Interval, list[int]]


def _present(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def _aggregate(df: DataFrame, intervals: Iterable[_Interval], aggregates: list[Column]) -> DataFrame:
    """One row over the rows any interval still holds."""
    needed = [i.holds() for i in intervals]
    return df.filter(functools.reduce(lambda a, b: a | b, needed)).agg(*aggregates)


def _sorted_out(df: DataFrame, searches: Searches) -> dict[tuple[str, int], Any]:
    """Sort the few rows of each interval and pick the ranks."""
    lists, picks, keys = [], [], []
    for n, (interval, ranks) in enumerate(searches.items()):
        values = F.collect_list(F.when(interval.holds(), F.col(interval.column)))
        lists.append(F.sort_array(values).alias(f"list{n}"))
        for rank in ranks:
            picks.append(F.col(f"list{n}")[rank - interval.below].alias(f"v{len(picks)}"))
            keys.append((interval.column, rank))
    row = _aggregate(df, searches, lists).select(*picks).first()
    return dict(zip(keys, row))


def _proposed(df: DataFrame, searches: Searches) -> dict[_Interval, list]:
    """Cut points around the wanted ranks of every interval, in order and among its rows."""
    aggregates, around = [], {}
    for n, (interval, ranks) in enumerate(searches.items()):
        shares = [(rank - interval.below) / interval.inside for rank in ranks]
        text = isinstance(interval.data_type, T.StringType)
        margin = 4 / math.sqrt(SAMPLE) if text else 2 / ACCURACY
        around[n] = sorted({min(1.0, max(0.0, s + d)) for s in shares for d in (-margin, margin)})
        value = F.when(interval.holds(), F.col(interval.column))
        if not text:
            aggregates.append(F.percentile_approx(value, around[n], ACCURACY).alias(f"p{n}"))
        aggregates += [F.min(value).alias(f"min{n}"), F.max(value).alias(f"max{n}")]
    row = _aggregate(df, searches, aggregates).first().asDict()
    for n, interval in enumerate(searches):
        if isinstance(interval.data_type, T.StringType):
            row[f"p{n}"] = _sampled(df, interval, around[n], row[f"min{n}"], row[f"max{n}"])
    # The approximation works on doubles, so a cut point may lie outside the rows.
    return {
        interval: _in_order({min(max(v, row[f"min{n}"], key=_sort_key), row[f"max{n}"], key=_sort_key) for v in row[f"p{n}"]})
        for n, interval in enumerate(searches)
    }


def _sort_key(value):
    """Text in the order of its bytes, as Spark compares it."""
    return value.encode() if isinstance(value, str) else value


def _in_order(values) -> list:
    return sorted(values, key=_sort_key)


def _sampled(df: DataFrame, interval: _Interval, shares: list[float], least: str, largest: str) -> list[str]:
    """Cut points near the given shares of an interval, from beginnings of about SAMPLE texts in it.

    What all its texts begin with is left out of the sample. Each beginning that is chosen gives two cut points, around
    all texts with it, so that these, if they are many, are an interval of their own in the next round, where what they
    begin with is longer.
    """
    same = os.path.commonprefix([least, largest])
    held = df.filter(interval.holds()).select(F.substring(interval.column, len(same) + 1, PREFIX))
    drawn = held.sample(min(1.0, SAMPLE / interval.inside), seed=interval.inside).limit(4 * SAMPLE).collect()
    values = _in_order(r[0] for r in drawn) or [largest[len(same) : len(same) + PREFIX]]
    chosen = {values[min(len(values) - 1, int(s * len(values)))] for s in shares}
    return [same + v + end for v in chosen for end in ("", LAST)]


def _narrowed(df: DataFrame, searches: Searches) -> tuple[Searches, dict[tuple[str, int], Any]]:
    """Cut every interval, count exactly, and keep the pieces that hold a wanted rank."""
    cuts = _proposed(df, searches)
    counts = []
    for n, (interval, points) in enumerate(cuts.items()):
        c, holds = F.col(interval.column), interval.holds()
        for k, point in enumerate(points):
            after = c > interval.lit(points[k - 1]) if k else F.lit(True)
            counts.append(F.count_if(holds & after & (c < interval.lit(point))).alias(f"lt{n}_{k}"))
            counts.append(F.count_if(holds & (c == interval.lit(point))).alias(f"eq{n}_{k}"))
    row = _aggregate(df, searches, counts).first()

    left, found = {}, {}
    for n, (interval, points) in enumerate(cuts.items()):
        waiting, low, below = sorted(searches[interval]), interval.low, interval.below
        for k, point in enumerate(points):
            less, equal = row[f"lt{n}_{k}"], row[f"eq{n}_{k}"]
            piece = replace(interval, low=low, high=point, below=below, inside=less)
            if ranks := [r for r in waiting if r < below + less]:
                left[piece] = ranks
            found |= {(interval.column, r): point for r in waiting if below + less <= r < below + less + equal}
            low, below = point, below + less + equal
            waiting = [r for r in waiting if r >= below]
        if waiting:
            rest = interval.below + interval.inside - below
            left[replace(interval, low=low, below=below, inside=rest)] = waiting
    return left, found


def _solve(df: DataFrame, searches: Searches, small: int) -> dict[tuple[str, int], Any]:
    """Values by (column, rank)."""
    found = {}
    while searches:
        ready = {
            i: ranks for i, ranks in searches.items()
            if i.inside <= (min(small, SMALL_TEXTS) if isinstance(i.data_type, T.StringType) else small)
        }
        if ready:
            found |= _sorted_out(df, ready)
            searches = {i: ranks for i, ranks in searches.items() if i not in ready}
        else:
            searches, values = _narrowed(df, searches)
            found |= values
    return found


def _column_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    types = {c: df.schema[c].dataType for c in columns}
    row = df.agg(*[F.count_if(_present(F.col(c), types[c])).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"n{i}"] for i, c in enumerate(columns)}


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]], small: int = SMALL) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation, nulls and NaN left out; None for an empty column.

    `df` is read a few times, so write it first if it is costly to compute.
    """
    counts = _column_counts(df, list(wanted))
    searches: Searches = {}
    for column, shares in wanted.items():
        n = counts[column]
        places = [Fraction(str(share)) * (n - 1) for share in shares] if n else []
        ranks = {r for at in places for r in (math.floor(at), math.ceil(at))}
        if ranks:
            searches[_Interval(column, df.schema[column].dataType, inside=n)] = sorted(ranks)
    found = _solve(df.select(*wanted), searches, small)

    def value(column: str, share: float) -> float | None:
        n = counts[column]
        if not n:
            return None
        at = Fraction(str(share)) * (n - 1)
        low, high = float(found[column, math.floor(at)]), float(found[column, math.ceil(at)])
        return low + (high - low) * float(at - math.floor(at))

    return {column: [value(column, share) for share in shares] for column, shares in wanted.items()}


def row_key_at(df: DataFrame, order: list[tuple[str, bool]], index: int, small: int = SMALL) -> list[Any] | None:
    """Key of the row at 0-based `index` in a total order; `order` lists (column, descending).

    The key columns are numbers, text, dates or timestamps. Nulls come last in both directions, NaN counts as the
    largest number. None when there are not that many rows.
    """
    if index < 0:
        return None
    left, key = index, []
    ties = df.select(*[name for name, _ in order])
    for name, descending in order:
        data_type, c = df.schema[name].dataType, F.col(name)
        present = _present(c, data_type)
        counts = ties.agg(F.count_if(present).alias("values"), F.count_if(c.isNotNull() & ~present).alias("nans"), F.count("*").alias("all")).first()
        if left >= counts["all"]:
            return None
        parts = [("values", counts["values"]), ("nans", counts["nans"]), ("nulls", counts["all"] - counts["values"] - counts["nans"])]
        if descending:
            parts[:2] = parts[1::-1]
        for part, n in parts:
            if left < n:
                break
            left -= n
        if part == "values":
            rank = n - 1 - left if descending else left
            found = _solve(ties, {_Interval(name, data_type, inside=n): [rank]}, small)[name, rank]
            same = c == literal(found, data_type)
            if len(key) + 1 < len(order):
                # Of the values, those before this one; NaN and null have been taken off.
                left -= ties.filter(present & (c > literal(found, data_type) if descending else c < literal(found, data_type))).count()
        else:
            found = None if part == "nulls" else math.nan
            same = c.isNull() if part == "nulls" else F.isnan(c)
        key.append(found)
        ties = ties.filter(same)
    return key
