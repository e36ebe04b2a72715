"""Keys and functional dependencies found in a table, and the narrow tables they propose.

The search goes level by level over sets of columns: the empty set first (constant columns), then single columns, then
pairs, up to `most` columns. A set is left out if a smaller one is a key, or if one of its columns depends on the others,
as nothing minimal can come of it; of a set only those columns are looked at that no smaller set determines.

A set is held against all its open columns at once. First on some of its groups, those where the hash of its most varied
column falls on zero: whole groups, so what they contradict is wrong for the table. These rows are written once, by that
column, for all sets that look at them. What is left is held against all rows by one hash aggregate (a group with two
hashes of a column contradicts), and what that leaves is confirmed by comparing values, of all columns of a set at once. Rows are pre-aggregated by the set before they move, so a hot group is a row a task; the driver sees a row a set.

Null is a value like others. The empty table and a table of one row have the empty set as their key.
"""

from __future__ import annotations

import functools
import itertools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.quality import dependency_violations
from millrace.scratch import new_folder, written

MOST_COLUMNS = 2
SOME_ROWS = 1_000_000  # held against a set at first
SETS_A_JOB = 40
SAMPLE_OF = "_sample_of"

Columns = tuple[str, ...]


@dataclass
class Found:
    """Minimal keys, and minimal dependencies (determinant, dependent), by level."""

    keys: list[Columns] = field(default_factory=list)
    dependencies: list[tuple[Columns, str]] = field(default_factory=list)


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _hash(column: str) -> Column:
    return F.xxhash64(_name(column), _name(column).isNull())


def _some(column: str, share: int) -> Column:
    """Whether a row's group by `column` is among one in `share` of them."""
    return F.pmod(_hash(column), F.lit(share)) == 0


def _samples(df: DataFrame, columns: list[str], share: int) -> dict[str, DataFrame]:
    """For each column the rows of some of its groups, from one pass over the table."""
    if not columns:
        return {}
    path = new_folder(df.sparkSession, "some")
    of = F.array_compact(F.array(*[F.when(_some(c, share), F.lit(i)) for i, c in enumerate(columns)]))
    some = df.select(*[_name(c) for c in df.columns], F.explode(of).alias(SAMPLE_OF))
    some.write.partitionBy(SAMPLE_OF).parquet(path)
    back = df.sparkSession.read.schema(some.schema).parquet(path)
    return {c: back.where(F.col(SAMPLE_OF) == i).drop(SAMPLE_OF) for i, c in enumerate(columns)}


def _contradicted(
    df: DataFrame, sets: dict[Columns, list[str]], share: int, varied: dict[str, int], samples: dict[str, DataFrame] | None = None
) -> dict[Columns, set]:
    """For each set the columns that take two values within a group, and "" if a group has two rows.

    Looks at one in `share` of the groups by the hash of the most varied column of a set, in `samples` if it has them.
    """
    out: dict[Columns, set] = {}
    todo = list(sets.items())
    for at in range(0, len(todo), SETS_A_JOB):
        parts = []
        for number, (own, others) in enumerate(todo[at : at + SETS_A_JOB]):
            some = df
            if own and share > 1:
                by = max(own, key=lambda c: varied[c])
                some = samples[by] if samples and by in samples else df.where(_some(by, share))
            values = [F.min(_hash(c)) != F.max(_hash(c)) for c in others]
            groups = some.groupBy(*[_name(c) for c in own]).agg(F.array(F.count("*") > 1, *values).alias("broken"))
            broken = F.array(*[F.coalesce(F.bool_or(F.col("broken")[i]), F.lit(False)) for i in range(len(others) + 1)])
            parts.append(groups.agg(broken.alias("broken")).select(F.lit(number).alias("n"), "broken"))
        for r in functools.reduce(DataFrame.union, parts).collect():  # a row a set
            own, others = todo[at + r.n]
            out[own] = {c for c, b in zip(["", *others], r.broken) if b}
    return out


def _confirmed(df: DataFrame, own: Columns, others: list[str]) -> list[str]:
    """The columns that take one value in every group."""
    if not others:
        return []
    if not own:
        return [c for c in others if df.select(_name(c)).distinct().limit(2).count() < 2]
    quoted = [f"`{c}`" for c in own]
    if dependency_violations(df, quoted, [f"`{c}`" for c in others]).isEmpty():
        return others
    return [c for c in others if dependency_violations(df, quoted, [f"`{c}`"]).isEmpty()] if len(others) > 1 else []


def _determined(own: Columns, found: list[tuple[Columns, str]]) -> set[str]:
    """Columns that a part of `own` determines."""
    return {c for parts, c in found if set(parts) <= set(own)}


def find_dependencies(
    df: DataFrame, columns: list[str] | None = None, most: int = MOST_COLUMNS, some_rows: int = SOME_ROWS, is_written: bool = False
) -> Found:
    """Minimal keys and dependencies with at most `most` columns on the left. A table that is a written one already is not copied."""
    columns = columns or df.columns
    rows = df.select(*[_name(c) for c in columns])
    rows = rows if is_written else written(rows, "dependencies")
    varied = rows.agg(*[F.approx_count_distinct(_name(c)).alias(f"v{i}") for i, c in enumerate(columns)], F.count("*").alias("n")).first()
    share = max(1, varied["n"] // some_rows)
    by_name = {c: varied[f"v{i}"] for i, c in enumerate(columns)}
    # Worth their writing if they are small together; of a column with few values one in `share` may be most rows.
    few = share >= 2 * len(columns)
    samples = _samples(rows, [c for c in columns if by_name[c] > share], share) if few else {}
    found = Found()
    for level in range(most + 1):
        sets: dict[Columns, list[str]] = {}
        for own in itertools.combinations(columns, level):
            if any(set(k) <= set(own) for k in found.keys):
                continue
            known = _determined(own, found.dependencies)
            if known & set(own):
                continue
            sets[own] = [c for c in columns if c not in own and c not in known]
        if not sets:
            break
        if share > 1:
            wrong = _contradicted(rows, sets, share, by_name, samples)
            sets = {own: [c for c in others if c not in wrong[own]] for own, others in sets.items()}
            sets = {own: others for own, others in sets.items() if others or "" not in wrong[own]}
        wrong = _contradicted(rows, sets, 1, by_name) if sets else {}
        for own, others in sets.items():
            is_key = "" not in wrong[own]
            if is_key:
                found.keys.append(own)
            held = [c for c in others if c not in wrong[own]]
            found.dependencies += [(own, c) for c in (held if is_key else _confirmed(rows, own, held))]
    return found


def closure(columns: set[str], dependencies: list[tuple[Columns, str]]) -> set[str]:
    """All columns that `columns` determine."""
    out = set(columns)
    while more := {c for own, c in dependencies if set(own) <= out} - out:
        out |= more
    return out


def minimal_cover(dependencies: list[tuple[Columns, str]]) -> list[tuple[Columns, str]]:
    """Dependencies without those that follow from the others; wide determinants go first."""
    kept = list(dependencies)
    for one in sorted(dependencies, key=lambda d: (-len(d[0]), dependencies.index(d))):
        rest = [d for d in kept if d != one]
        if one[1] in closure(set(one[0]), rest):
            kept = rest
    return kept


def proposed_split(columns: list[str], found: Found) -> dict[str, list[str]]:
    """Narrow tables, each a determinant and what depends on it; joined on their shared columns they give the wide table.

    The synthesis of a third normal form: a table for each determinant of a minimal cover, one with a key of the whole if
    none has it, and none that lies within another. Names are the determinants'.
    """
    cover = minimal_cover(found.dependencies)
    tables: dict[Columns, list[str]] = {}
    for own, c in cover:
        if own:
            tables.setdefault(own, list(own)).append(c)
    constant = [c for own, c in cover if not own]
    # A key of the whole: all columns, without those that the others determine.
    key = [c for c in columns if c not in constant]
    for c in reversed(key):
        rest = [k for k in key if k != c]
        if closure({*rest, *constant}, cover) >= set(columns):
            key = rest
    if constant or not any(closure(set(t), cover) >= set(columns) for t in tables.values()):
        tables[tuple(key)] = [*tables.get(tuple(key), key), *constant]
    ordered = {"_".join(own) or "all": [c for c in columns if c in t] for own, t in tables.items()}
    return {n: t for n, t in ordered.items() if not any(set(t) < set(o) for o in ordered.values())}


def join_order(columns: list[str], tables: dict[str, list[str]], cover: list[tuple[Columns, str]]) -> list[tuple[str, list[str]]]:
    """Tables with the columns each is joined on, from one that holds a key of the whole; every join adds no rows."""
    left = dict(tables)
    first = next(n for n, t in left.items() if closure(set(t), cover) >= set(columns))
    have, order = set(left.pop(first)), [(first, [])]
    while left:
        name = next(n for n, t in left.items() if closure(have & set(t), cover) >= set(t))
        order.append((name, [c for c in left[name] if c in have]))
        have |= set(left.pop(name))
    return order


def rejoin_split(tables: dict[str, DataFrame], order: list[tuple[str, list[str]]], columns: list[str]) -> DataFrame:
    """The distinct rows of the wide table from its narrow ones. Nulls join."""
    (first, _), *rest = order
    out = tables[first]
    for name, on in rest:
        other = tables[name]
        other = other.select(*[_name(c).alias(f"_on{i}" if c in on else c) for i, c in enumerate(other.columns)])
        same = [_name(c).eqNullSafe(F.col(f"_on{tables[name].columns.index(c)}")) for c in on]
        out = out.join(other, functools.reduce(lambda a, b: a & b, same)).drop(*[c for c in other.columns if c.startswith("_on")])
    return out.select(*[_name(c) for c in columns])
