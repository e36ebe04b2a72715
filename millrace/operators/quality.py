"""Row rules, keys, dependencies, and the split into narrow tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import trimmed


@dataclass(frozen=True)
class Rule:
    """A row passes when `holds` is true; null counts as a failure."""

    field: str
    holds: Column
    message: str


def filled_text(field: str) -> Rule:
    """Present and at least one character long; a blank is a character."""
    return Rule(field, F.length(field) >= 1, "must be text of at least 1 character")


# Decimal digits with a sign, a point and an exponent at most; no suffixes, no hexadecimal numbers.
NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?|nan)\s*$"


def positive_number(field: str) -> Rule:
    """A number, or text that reads as one, above zero. NaN fails, infinity passes."""
    text = F.col(field).cast("string")
    number = F.when(text.rlike(NUMBER), F.expr(f"try_cast(`{field}` AS double)"))
    return Rule(field, (number > 0) & ~F.isnan(number), "must be a number greater than 0")


def not_below(field: str, bound) -> Rule:
    return Rule(field, F.col(field) >= bound, f"must not be below {bound}")


def sales_rules() -> list[Rule]:
    return [filled_text("region"), filled_text("month"), positive_number("amount")]


def judged(df: DataFrame, rules: list[Rule], name: str = "errors") -> DataFrame:
    """Add the messages of all broken rules, in rule order."""
    messages = [
        F.when(~F.coalesce(r.holds, F.lit(False)), F.lit(f"{r.field}: {r.message}")) for r in rules
    ]
    return df.withColumn(name, F.array_compact(F.array(*messages)))


def valid_rows(judged_df: DataFrame, name: str = "errors") -> DataFrame:
    return judged_df.filter(F.size(name) == 0).drop(name)


def error_rows(judged_df: DataFrame, row: str, name: str = "errors") -> DataFrame:
    """One row per broken record: its number and all messages."""
    return judged_df.filter(F.size(name) > 0).select(
        F.col(row).alias("row"), F.array_join(name, "; ").alias("error")
    )


def reconciled(whole: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """Do the parts add up to the whole?"""
    counts = whole.agg(F.count("*").alias("whole"))
    for name, part in parts.items():
        counts = counts.withColumn(name, part.agg(F.count("*")).scalar())
    total = sum((F.col(n) for n in parts), F.lit(0))
    return counts.withColumn("agrees", F.col("whole") == total)


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once or have a null part."""
    broken = F.col("n") > 1
    for k in key:
        broken = broken | F.col(k).isNull()
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter(broken)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent and how many rows carry them; null keys are allowed.

    Both sides are reduced to distinct keys first, so no hot key reaches the join.
    """
    used = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias("_known")).distinct()
    return used.join(known, used[child_key] == known["_known"], "left_anti")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "nulls")


def dependency_violations(df: DataFrame, determinant: list[str], dependent: list[str]) -> DataFrame:
    """Determinants with more than one dependent value."""
    pairs = df.select(*determinant, *dependent).distinct()
    return pairs.groupBy(*determinant).agg(F.count("*").alias("n")).filter("n > 1")


def split_tables(wide: DataFrame, tables: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Narrow tables of a wide one, each with its distinct rows."""
    return {name: wide.select(*columns).distinct() for name, columns in tables.items()}


def rejoined(items: DataFrame, parents: list[tuple[DataFrame, str]], columns: list[str]) -> DataFrame:
    """The wide table back from the narrow ones, in the order of its foreign keys."""
    out = items
    for parent, key in parents:
        out = out.join(parent, key)
    return out.select(*columns)


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that do not occur equally often on both sides, with the surplus on the left.

    One hash aggregate over both inputs; equal rows collapse before the shuffle.
    """
    columns = left.columns
    both = left.select(*columns, F.lit(1).cast("long").alias("_n")).unionAll(
        right.select(*columns, F.lit(-1).cast("long").alias("_n"))
    )
    return both.groupBy(*columns).agg(F.sum("_n").alias("surplus")).filter("surplus <> 0")


def rejoined_differences(wide: DataFrame, items: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Row differences between a wide table and the join of `items` with `parent` on `key`.

    `items` has the key, and `parent` all columns of the wide table that `items` lacks. Both sides are shuffled once, by
    the key: wide rows pass the join without a match, and equal rows meet in the task that joins them.
    """
    columns, own = wide.columns, set(items.columns)
    lacking = [c for c in columns if c not in own]
    blank = [F.col(c) if c in own else F.lit(None).cast(wide.schema[c].dataType).alias(c) for c in columns]
    both = wide.select(*columns, F.lit(1).cast("long").alias("_n")).unionAll(
        items.select(*blank, F.lit(-1).cast("long").alias("_n"))
    )
    known = parent.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in lacking])
    met = both.join(known, (F.col(key) == F.col("_key")) & (F.col("_n") < 0), "left")
    back = met.where("_n > 0 OR _key IS NOT NULL").select(
        *[F.when(F.col("_n") < 0, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in lacking else c for c in columns], "_n"
    )
    return back.groupBy(*columns).agg(F.sum("_n").alias("surplus")).filter("surplus <> 0")


def counted_differences(differences: DataFrame) -> DataFrame:
    """One row: how many rows differ, each as often as it is in surplus, and whether none does."""
    n = F.coalesce(F.sum(F.abs("surplus")), F.lit(0).cast("long"))
    return differences.agg(n.alias("different")).withColumn("same", F.col("different") == 0)


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many rows one side has more of than the other, and whether there are none."""
    return counted_differences(row_differences(left, right))


def guarded_titles(df: DataFrame, title: str) -> DataFrame:
    """Trim the title and refuse rows where nothing is left."""
    return df.withColumn(title, trimmed(title)).filter(F.col(title) != "")


def judged_records(records: DataFrame) -> DataFrame:
    """Judge sales records that still have their own JSON types: (row, record variant).

    Region and month have to be text, the category text or absent; the amount may be a number
    or text that reads as one. Other fields are ignored.
    """
    def part(field: str, data_type: str) -> Column:
        return F.try_variant_get("record", f"$.{field}", data_type)

    def is_text(field: str) -> Column:
        return F.schema_of_variant(part(field, "variant")) == "STRING"

    typed = records.select(
        "row",
        F.when(is_text("region"), part("region", "string")).alias("region"),
        F.when(is_text("month"), part("month", "string")).alias("month"),
        part("amount", "string").alias("amount"),
        part("category", "string").alias("category"),
        (part("category", "string").isNull() | is_text("category")).alias("_text_category"),
    )
    rules = sales_rules() + [Rule("category", F.col("_text_category"), "must be text")]
    return judged(typed, rules).drop("_text_category").withColumn("amount", F.expr("try_cast(amount AS double)"))
