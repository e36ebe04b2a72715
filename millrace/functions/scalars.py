"""Column expressions. Each takes and returns a Column and stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Fixed-point money, so that sums do not depend on the order of addition."""
    return col(c).cast("decimal(18,2)")


def _units(c, places: int) -> Column:
    """An amount in whole units of its last place; one that does not fit them fails the job. NaN is no amount."""
    scaled = col(c).cast("double") * 10.0**places
    units = F.rint(scaled)
    # Beyond 2^43 units neighbouring doubles lie further apart than the first term.
    misfit = F.abs(scaled - units) > F.greatest(F.lit(1e-3), F.abs(units) * 5e-16)
    wrong = F.raise_error(F.format_string(f"%s has more than {places} places", col(c).cast("string"))).cast("double")
    return F.when(~F.isnan(scaled), F.when(misfit, wrong).otherwise(units)).cast("bigint")


# Units are added in two parts so that the sums stay within a long: the lower parts of 2^43
# rows fit, and a sum that does not fit fails the job.
LOW_BITS = 20


def money_sum(c, places: int = 2) -> Column:
    """Exact sum of amounts of so many places, null where there is none; up to 10^15 units each.

    Sums of longs run several times faster than sums of decimals.
    """
    units = _units(c, places)
    high = F.sum(F.shiftright(units, LOW_BITS)).cast("decimal(25,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint"))).cast("decimal(25,0)")
    total = high * F.lit(1 << LOW_BITS).cast("decimal(7,0)") + low
    unit = F.lit("1e-%d" % places).cast(f"decimal({max(places, 1)},{places})")
    return (total * unit).cast(f"decimal(38,{places})")


def average(c, places: int = 2) -> Column:
    """Mean of an amount from its exact sum; null when there is no value. NaN is no value."""
    return money_sum(c, places).cast("double") / F.nullif(F.count(_units(c, places)), F.lit(0))


# --- dates -----------------------------------------------------------------------------

def whole_years(birth, as_of) -> Column:
    """Completed years from `birth` to `as_of`; a 29 February birth turns on 1 March."""
    birth, as_of = col(birth), col(as_of)
    not_yet = F.date_format(as_of, "MMdd") < F.date_format(birth, "MMdd")
    return F.year(as_of) - F.year(birth) - F.when(not_yet, 1).otherwise(0)


def month_start(c) -> Column:
    return F.trunc(col(c), "MM")


def month_text(c) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def day_text(c) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def weekday_name(c) -> Column:
    return F.date_format(col(c), "EEEE")


def utc_day(c) -> Column:
    """Calendar day of an instant; the session time zone is UTC."""
    return F.to_date(col(c))


def strict_date(c, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to date; a bad value fails the job."""
    return F.to_date(col(c), pattern)


def lenient_date(c, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to date; a bad value becomes null."""
    return F.try_to_date(col(c), pattern)


# --- text ------------------------------------------------------------------------------

# White space in Unicode and line ends, as scripts in web pages trim them.
WHITE = "\t\n\x0b\x0c\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def trimmed(c) -> Column:
    return F.btrim(col(c), F.lit(WHITE))


def html_escaped(c) -> Column:
    """Text made safe inside an element; quotes stay as they are."""
    out = col(c)
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), (" ", "&nbsp;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def first_line(c) -> Column:
    return F.split(col(c), "\r\n|\r|\n")[0]


def with_thousands(c, places: int = 0) -> Column:
    return F.format_number(col(c), places)


def rotating_pick(items, day) -> Column:
    """Element number `day of month % length` (from 0) of an array."""
    items = col(items)
    return F.element_at(items, (F.day(col(day)) % F.size(items) + 1).cast("int"))


# --- branches and levels ---------------------------------------------------------------

# The labels of the three age groups and of an unknown region.
AGE_LABELS = ("청년", "중년", "장년")
UNKNOWN_REGION = "미상"


def age_group(age, young_below: int = 30, middle_to: int = 49, labels=AGE_LABELS) -> Column:
    """Three age groups; an unknown age falls into the last one."""
    age = col(age)
    return (
        F.when(age < young_below, labels[0])
        .when(age.between(young_below, middle_to), labels[1])
        .otherwise(labels[2])
    )


def activity_level(count) -> Column:
    """0, 1, 2, or 3 for three and more."""
    return F.least(col(count), F.lit(3)).cast("int")


# Points per completed goal and points per level.
XP_PER_GOAL = 10
XP_PER_LEVEL = 50


def level_of(xp) -> Column:
    return (F.floor(col(xp) / XP_PER_LEVEL) + 1).cast("long")


def level_percent(xp) -> Column:
    return F.round((col(xp) % XP_PER_LEVEL) * 100 / XP_PER_LEVEL).cast("long")


def percent_done(done, total) -> Column:
    """Whole percent, half up; 0 when there is nothing."""
    done, total = col(done), col(total)
    return F.when(total == 0, 0).otherwise(F.round(done * 100 / F.nullif(total, F.lit(0)))).cast("long")
