"""Filter conditions, written so that they reach the Parquet scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import col, trimmed


def literal(value, data_type: T.DataType) -> Column:
    """A constant of the column's own type, so that the column itself is not cast."""
    if isinstance(value, dt.date):  # datetime is a date too
        return F.lit(str(value)).cast(data_type)
    return F.lit(value).cast(data_type)


def at_least(c, bound) -> Column:
    return col(c) >= bound


def above(c, bound) -> Column:
    return col(c) > bound


def outside(c, low, high) -> Column:
    """Not between the bounds; a null counts as outside."""
    c = col(c)
    return c.isNull() | (c < low) | (c > high)


def in_year(c, year: int) -> Column:
    """`year(c) = year` as a half-open range."""
    c = col(c)
    return (c >= F.lit(dt.date(year, 1, 1))) & (c < F.lit(dt.date(year + 1, 1, 1)))


def on_day(c, day: dt.date) -> Column:
    c = col(c)
    return (c >= F.lit(day)) & (c < F.lit(day + dt.timedelta(days=1)))


def since(c, day: dt.date) -> Column:
    return col(c) >= F.lit(day)


def past_key(order: list[tuple[str, bool]], values: list[Column | None], with_nulls: bool = True) -> Column:
    """Rows after a boundary row in a lexicographic order.

    `order` lists (column, descending), nulls last in both directions; None is the boundary's null. The bound on the
    leading column stands on its own, since only plain comparisons are pushed to the scan. Without `with_nulls` a row
    with a null key is never after another.
    """
    def beyond(name, descending, value, inclusive):
        c = F.col(name)
        if value is None:
            return c.isNull() if inclusive else F.lit(False)
        if descending:
            after = c <= value if inclusive else c < value
        else:
            after = c >= value if inclusive else c > value
        return after | c.isNull() if with_nulls else after

    (name, descending), value = order[0], values[0]
    if len(order) == 1:
        return beyond(name, descending, value, False)
    rest = past_key(order[1:], values[1:], with_nulls)
    same = F.col(name).isNull() if value is None else F.col(name) == value
    return beyond(name, descending, value, True) & (beyond(name, descending, value, False) | (same & rest))


# Fixed pattern: one lower-case letter, one upper-case letter, one digit of any script, one
# other character, on a single line. (?d) lets only \n end a line.
ALL_CLASSES = r"(?d)^(?=.*[a-z])(?=.*[A-Z])(?=.*\p{Nd})(?=.*[^a-zA-Z0-9]).+$"


def has_all_classes(c) -> Column:
    return col(c).rlike(ALL_CLASSES)


def title_contains(c, keyword: str) -> Column:
    """Case-sensitive search; a blank keyword keeps everything."""
    keyword = keyword.strip()
    return col(c).contains(keyword) if keyword else F.lit(True)


def in_tab(done, tab: str) -> Column:
    """The status tabs: all, active, done."""
    done = F.coalesce(col(done), F.lit(False))
    return {"all": F.lit(True), "active": ~done, "done": done}[tab]


def overdue(due, done, as_of: dt.date) -> Column:
    due = col(due)
    return due.isNotNull() & ~F.coalesce(col(done), F.lit(False)) & (due < F.lit(as_of))


def usable_due(due, as_of: dt.date) -> Column:
    """A due day before `as_of` is dropped."""
    due = col(due)
    return F.when(due >= F.lit(as_of), due)


def usable_title(title) -> Column:
    return trimmed(title) != ""
