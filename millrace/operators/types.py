"""Types of text columns, from all their values.

Types form a lattice: null lies below bigint and date, bigint below double, and text above double and date. A column's
type is the join of its values' types. Joins of all columns are counts, so one aggregate over all rows finds them, merged
from partial counts, and a misfit in the last row counts like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# No white space, no suffixes: a value with them is text.
WHOLE = r"^[+-]?[0-9]+$"
DECIMAL = r"(?i)^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf(?:inity)?|nan)$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _fits(value: Column, name: str) -> dict[str, Column]:
    """Whether a value is of each type; one that is a bigint is a double too."""
    quoted = name.replace("`", "``")
    return {
        "bigint": value.rlike(WHOLE) & F.expr(f"try_cast(`{quoted}` as bigint)").isNotNull(),
        "double": value.rlike(DECIMAL),
        "date": value.rlike(DAY) & F.expr(f"try_cast(`{quoted}` as date)").isNotNull(),
    }


def value_types(df: DataFrame, columns: list[str], dates: bool = True) -> DataFrame:
    """Rows (column, type, values, nulls) of text columns; null and empty text are nulls.

    `type` is null, bigint, double, date or string. Whole numbers beyond a bigint are doubles. With `dates` off, dates are
    text.
    """
    counts, rows = [], []
    for i, name in enumerate(columns):
        value = F.col("`" + name.replace("`", "``") + "`")
        there = value.isNotNull() & (value != "")
        counts += [F.count_if(there).alias(f"n{i}"), F.count_if(~there).alias(f"nulls{i}")]
        counts += [F.count_if(there & fits).alias(f"{t}{i}") for t, fits in _fits(value, name).items()]
        n = F.col(f"n{i}")
        kind = F.when(n == 0, "null").when(F.col(f"bigint{i}") == n, "bigint").when(F.col(f"double{i}") == n, "double")
        kind = kind.when((F.col(f"date{i}") == n) & F.lit(dates), "date").otherwise("string")
        rows.append(F.struct(F.lit(name).alias("column"), kind.alias("type"), n.alias("values"), F.col(f"nulls{i}").alias("nulls")))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def inferred_types(df: DataFrame, columns: list[str], dates: bool = True) -> dict[str, str]:
    """The narrowest type of each text column; string for one without values."""
    found = {r.column: r.type for r in value_types(df, columns, dates).collect()}  # a row a column
    return {c: "string" if found[c] == "null" else found[c] for c in columns}
