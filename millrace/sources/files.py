"""Text, JSON and CSV files."""

from __future__ import annotations

import csv
import logging
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import types
from millrace.scratch import written
from millrace.sources import split

log = logging.getLogger(__name__)


def _type(schema: T.DataType | str) -> T.DataType:
    return T.DataType.fromDDL(schema) if isinstance(schema, str) else schema


# --- JSON --------------------------------------------------------------------------------

# A file that is one array is read by one task, which is right for many small files. With `range_bytes` it is read by one
# task for each so many bytes (see split.py), which is right for large ones; with `one_text` too, the files of a folder are
# one array that was cut behind commas, in the order of their paths. With `whole_file` off every line holds an
# array of its own, and files are split at lines.

def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType | str, whole_file: bool = True, range_bytes: int | None = None,
    one_text: bool = False,
) -> DataFrame:
    """Records of files that each hold one array of objects."""
    if range_bytes:
        record = F.from_json("item", _type(schema), {"mode": "FAILFAST"})
        return split.array_items(spark, path, range_bytes, one_text=one_text).select(record.alias("record")).select("record.*")
    return spark.read.schema(schema).json(path, multiLine=whole_file)


def read_json_records(
    spark: SparkSession, path: str, whole_file: bool = True, range_bytes: int | None = None, one_text: bool = False
) -> DataFrame:
    """(row, record) of JSON arrays, the records as variants that keep their own field types.

    `row` counts from 0 within an array.
    """
    if range_bytes:
        return split.array_items(spark, path, range_bytes, one_text=one_text).select("row", F.parse_json("item").alias("record"))
    texts = spark.read.text(path, wholetext=whole_file).withColumn("_json", F.parse_json("value"))
    return texts.lateralJoin(
        spark.tvf.variant_explode(F.col("_json").outer()).select(F.col("pos").alias("row"), F.col("value").alias("record"))
    ).select("row", "record")


def read_assigned_list(
    spark: SparkSession, path: str, name: str, schema: T.StructType | str, whole_file: bool = True, range_bytes: int | None = None,
    one_text: bool = False,
) -> DataFrame:
    """Rows of text of the form `name = [ {...}, ... ]`, with their position `row` from 0.

    The text is parsed as data and never evaluated. Text without the assignment fails the job.
    """
    if range_bytes:
        record = F.from_json("item", _type(schema), {"mode": "FAILFAST"})
        return split.array_items(spark, path, range_bytes, name, one_text).select("row", record.alias("record")).select("row", "record.*")
    body = F.regexp_extract("value", rf"(?s)^\s*{re.escape(name)}\s*=\s*(\[.*\])\s*$", 1)
    found = F.when(body != "", body).otherwise(
        F.raise_error(F.lit(f"no list is assigned to {name}")).cast("string")
    )
    records = F.from_json(found, T.ArrayType(_type(schema)), {"mode": "FAILFAST"})
    return (
        spark.read.text(path, wholetext=whole_file)
        .select(F.posexplode(records).alias("row", "record"))
        .select("row", "record.*")
    )


def read_string_list(
    spark: SparkSession, path: str, whole_file: bool = True, range_bytes: int | None = None, one_text: bool = False
) -> DataFrame:
    """Items of JSON arrays of strings with their position from 0."""
    if range_bytes:
        # An item is a list of one string here, as a string alone is not read as JSON.
        one = F.from_json(F.concat(F.lit("["), "item", F.lit("]")), T.ArrayType(T.StringType()), {"mode": "FAILFAST"})
        return split.array_items(spark, path, range_bytes, one_text=one_text).select(F.col("row").alias("position"), one[0].alias("item"))
    items = F.from_json("value", T.ArrayType(T.StringType()), {"mode": "FAILFAST"})
    return spark.read.text(path, wholetext=whole_file).select(F.posexplode(items).alias("position", "item"))


def write_json_lines(df: DataFrame, path: str) -> None:
    """One object per line in UTF-8, null fields kept, other scripts written as they are."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


# --- CSV ---------------------------------------------------------------------------------

# A quote inside a quoted field is doubled, as other CSV writers do it, and white space belongs to its field. The names
# in a file's header count, not the order that a reader would like.
CSV_OPTIONS = {
    "header": True, "escape": '"', "enforceSchema": False, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _csv_split(spark: SparkSession, path: str, columns: list[str] | None, range_bytes: int) -> DataFrame:
    """The columns as text, read in ranges."""
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV_OPTIONS.items() if k not in ("header", "enforceSchema")}
    # Line breaks in fields stay as they are.
    options |= {"multiLine": "true", "mode": "FAILFAST"}
    records = split.csv_records(spark, path, range_bytes)
    first = F.row_number().over(Window.partitionBy("path").orderBy("row"))
    heads = written(records.where("row < 100").withColumn("_n", first).where("_n = 1").select("path", "row", "record"), "heads")
    found = [r[0] for r in heads.select("record").distinct().take(2)]
    if not found:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns or []))
    if len(found) > 1:
        raise ValueError(f"headers of {path} differ: {found}")
    [names] = csv.reader([found[0]])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    marked = records.join(F.broadcast(heads.select("path", "row", F.lit(True).alias("head"))), ["path", "row"], "left")  # a row a file
    # A condition on a field may be looked at before headers are left out, so they have no fields.
    record = F.when(F.col("head").isNull(), F.col("record"))
    fields = marked.where("head is null").select(F.from_csv(record, schema.simpleString(), options).alias("f")).select("f.*")
    return fields.select(*[f"`{c}`" for c in columns or names])


def _csv_fields(
    spark: SparkSession, path: str, columns: list[str] | None, multi_line: bool, range_bytes: int | None = None
) -> DataFrame:
    """The named columns, or all, as text. Files of one path have to agree on their header."""
    if range_bytes:
        return _csv_split(spark, path, columns, range_bytes)
    options = CSV_OPTIONS | {"multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return spark.read.options(**options).schema(schema).csv(path).select(*[f"`{c}`" for c in columns or header])


# A file with line breaks in its fields is read by one task, or in ranges by many with `range_bytes` (see split.py).

def read_csv_text(
    spark: SparkSession, path: str, columns: list[str] | None, multi_line: bool = False, range_bytes: int | None = None
) -> DataFrame:
    """The named columns, or all: every field a string, an empty one the empty string. `multi_line` for fields with line breaks in them."""
    return _csv_fields(spark, path, columns, multi_line, range_bytes).na.fill("")


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    overrides: dict[str, str] | None = None,
    multi_line: bool = False,
    range_bytes: int | None = None,
) -> DataFrame:
    """Typed fields, an empty one null, one that cannot be read an error; `overrides` replaces the type of columns."""
    fields = _type(schema).fields
    wanted = {f.name: (overrides or {}).get(f.name, f.dataType) for f in fields}
    text = _csv_fields(spark, path, list(wanted), multi_line, range_bytes)
    return text.select(*[F.nullif(F.col(n), F.lit("")).cast(t).alias(n) for n, t in wanted.items()])


def read_csv_inferred(
    spark: SparkSession, path: str, multi_line: bool = False, range_bytes: int | None = None, dates: bool = True
) -> DataFrame:
    """All columns, each with the narrowest type that holds every one of its values; an empty field is null.

    The types come from all values, none is sampled (see types.value_types). With `dates` off, dates stay text. A column
    without values is text.
    """
    text = _csv_fields(spark, path, None, multi_line, range_bytes)
    found = types.inferred_types(text, text.columns, dates)
    return text.select(*[F.nullif(F.col(f"`{n}`"), F.lit("")).cast(t).alias(n) for n, t in found.items()])


def csv_misfits(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """Rows (column, value) of the fields that read_csv_typed would fail at."""
    wanted = {f.name: f.dataType.simpleString() for f in _type(schema).fields}
    text = _csv_fields(spark, path, list(wanted), multi_line)
    bad = [
        F.when((F.col(n) != "") & F.expr(f"try_cast(`{n}` AS {t})").isNull(), F.struct(F.lit(n).alias("column"), F.col(n).alias("value")))
        for n, t in wanted.items()
    ]
    return text.select(F.explode(F.array_compact(F.array(*bad))).alias("bad")).select("bad.*")


def write_csv(df: DataFrame, path: str, columns: list[str], multi_line: bool = False) -> None:
    """Header and a fixed column order. Fields with line breaks fail the job unless readers are to expect them."""
    types = dict(df.dtypes)
    out = df.select(*columns)
    if not multi_line:
        refuse = F.raise_error(F.lit("a field has a line break; write and read it with multi_line")).cast("string")
        out = out.withColumns({
            c: F.when(F.col(c).rlike(r"[\r\n]"), refuse).otherwise(F.col(c)) for c in columns if types[c] == "string"
        })
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


# --- missing and broken files --------------------------------------------------------------

def is_there(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern leads to anything; a missing one is logged."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    if found:
        return True
    log.warning("nothing at %s", path)
    return False


def json_if_there(spark: SparkSession, path: str, schema: T.StructType | str, whole_file: bool = True) -> DataFrame | None:
    """Records of JSON arrays with the fields of `schema`; None if the path is missing or a text is not JSON.

    A field of another type than wanted is cast if it can be and null otherwise; read_json_records keeps it as it is, for
    records that have to be judged. Only the syntax is looked at before this returns.
    """
    if not is_there(spark, path):
        return None
    texts = spark.read.text(path, wholetext=whole_file)
    if texts.where(F.try_parse_json("value").isNull() & (F.trim("value") != "")).take(1):
        log.warning("not JSON: %s", path)
        return None
    fields = _type(schema).fields
    records = read_json_records(spark, path, whole_file)
    return records.select(*[F.try_variant_get("record", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in fields])


def csv_if_there(spark: SparkSession, path: str, columns: list[str]) -> DataFrame | None:
    """The file's columns as text, or None if it is missing."""
    return read_csv_text(spark, path, columns) if is_there(spark, path) else None


def reload_matches(written: DataFrame, reloaded: DataFrame) -> DataFrame:
    """Rows before writing, rows after reading back, and whether they agree."""
    counts = written.agg(F.count("*").alias("written")).withColumn("reloaded", reloaded.agg(F.count("*")).scalar())
    return counts.withColumn("same", F.col("written") == F.col("reloaded"))


def array_lines(df: DataFrame, chunk: Column, order: str, record: Column | None = None) -> DataFrame:
    """Rows as lines of JSON arrays, one array per chunk; chunks are small by construction."""
    text = F.to_json(F.struct(*df.columns)) if record is None else record
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), text.alias("_r"))))
    return (
        df.groupBy(chunk.alias("_chunk"))
        .agg(ordered.alias("_rows"))
        .select(F.concat(F.lit("["), F.array_join("_rows._r", ","), F.lit("]")).alias("value"))
    )
