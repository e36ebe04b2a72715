"""Reading and writing files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import money_sum
from millrace.operators import types
from millrace.operators.aggregates import totals_by
from millrace.operators.quality import error_rows, judged, judged_records, positive_number, valid_rows
from millrace.plans.registry import SALES, query, total
from millrace.scratch import new_folder, written
from millrace.sources import files, split, tables
from millrace.sources.tables import Tables

# Records per JSON array in the files written here.
ARRAY_ROWS = 500
ORDER_FIELDS = "o_orderkey bigint, o_orderstatus string, o_totalprice double"


def _array_lines(t: Tables, prefix: str = "") -> str:
    """Orders as lines of JSON arrays; keys are unique, so an array has at most ARRAY_ROWS records."""
    path = new_folder(t.spark, "arrays")
    fields = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    chunk = F.floor(F.col("o_orderkey") / ARRAY_ROWS)
    files.array_lines(fields, chunk, "o_orderkey").select(F.concat(F.lit(prefix), "value")).write.text(path)
    return path


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def read_json_array(t: Tables) -> DataFrame:
    return files.read_json_array(t.spark, _array_lines(t), ORDER_FIELDS, whole_file=False)


@query(f"""
SELECT CAST(row_number() OVER (PARTITION BY o_orderkey // {ARRAY_ROWS} ORDER BY o_orderkey) - 1 AS INTEGER) AS row,
       o_orderkey, o_orderstatus, o_totalprice
FROM orders""")
def read_assigned_list(t: Tables) -> DataFrame:
    return files.read_assigned_list(t.spark, _array_lines(t, "sales = "), "sales", ORDER_FIELDS, whole_file=False)


@query("""
SELECT CAST(unnest(range(len(lines))) AS INTEGER) AS position, unnest(lines) AS item
FROM (SELECT string_split(text, chr(10)) AS lines FROM documents)""")
def string_list_positions(t: Tables) -> DataFrame:
    """The lines of every document, written and read as a JSON array of strings."""
    path = new_folder(t.spark, "lists")
    t.documents.select(F.to_json(F.split("text", "\n"))).write.text(path)
    return files.read_string_list(t.spark, path, whole_file=False)


def _one_array(t: Tables, df: DataFrame, key: str, record, before: str = "[") -> str:
    """One JSON array of `record` in the order of a unique key, cut behind commas into files that many tasks write.

    The last file, of one row, has the last item and the array's end.
    """
    path = new_folder(t.spark, "one-array")
    least, last = df.agg(F.min(key), F.max(key)).first()  # one row
    item = F.concat(F.when(F.col(key) == F.lit(least), before).otherwise(""), record)
    # No line breaks between items: the whole text is one line. Spark names the files of a sorted table in its order.
    items = df.where(F.col(key) < F.lit(last)).select(F.col(key).alias("key"), item.alias("value")).orderBy("key")
    items.select("value").write.option("lineSep", ",").text(f"{path}/part=0")
    end = t.spark.range(1).select(F.lit(f"{before}]").alias("value"))
    if last is not None:
        end = df.where(F.col(key) == F.lit(last)).select(F.concat(item, F.lit("]")).alias("value"))
    end.coalesce(1).write.option("lineSep", " ").text(f"{path}/part=1")
    return path


def _order_record():
    return F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_totalprice"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def split_json_array(t: Tables) -> DataFrame:
    """One array on one line, written and read by many tasks."""
    path = _one_array(t, t.orders, "o_orderkey", _order_record())
    return files.read_json_array(t.spark, path, ORDER_FIELDS, range_bytes=split.fair_range(t.spark, path), one_text=True)


@query("""
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row, o_orderkey, o_orderstatus, o_totalprice FROM orders""")
def split_assigned_list(t: Tables) -> DataFrame:
    path = _one_array(t, t.orders, "o_orderkey", _order_record(), "sales = [")
    return files.read_assigned_list(t.spark, path, "sales", ORDER_FIELDS, range_bytes=split.fair_range(t.spark, path), one_text=True)


@query("SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, text AS item FROM documents")
def split_string_list(t: Tables) -> DataFrame:
    """Whole texts, with quotes, commas and escapes in them, as one array of strings."""
    # An array of one string, without its brackets, is the string as JSON has it.
    quoted = F.regexp_extract(F.to_json(F.array("text")), r"(?s)^\[(.*)\]$", 1)
    path = _one_array(t, t.documents, "doc_id", quoted)
    return files.read_string_list(t.spark, path, range_bytes=split.fair_range(t.spark, path), one_text=True)


@query("""
SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row,
       CASE WHEN c_acctbal > 0 THEN '' ELSE 'amount: must be a number greater than 0' END AS error
FROM customer""")
def split_judged_json(t: Tables) -> DataFrame:
    """Records of one array that keep their JSON types, judged; every third amount is text that reads as a number."""
    def record(amount):
        return F.to_json(F.struct(F.col("c_mktsegment").alias("region"), F.col("c_name").alias("month"), amount.alias("amount")))

    amount = F.col("c_acctbal")
    text = F.when(F.col("c_custkey") % 3 == 0, record(amount.cast("string"))).otherwise(record(amount))
    path = _one_array(t, t.customer, "c_custkey", text)
    records = files.read_json_records(t.spark, path, range_bytes=split.fair_range(t.spark, path), one_text=True)
    return judged_records(records).select("row", F.array_join("errors", "; ").alias("error"))


CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def read_csv_text(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "customers")
    gaps = t.customer.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    files.write_csv(gaps, path, CUSTOMER_COLUMNS)
    return files.csv_if_there(t.spark, path, CUSTOMER_COLUMNS)


@query("SELECT doc_id, '  ' || text || chr(10) || ' \"quoted, twice\" ' AS text, '' AS note FROM documents")
def csv_roundtrip(t: Tables) -> DataFrame:
    """Whole texts, padded and of many lines, written and read back by header."""
    path = new_folder(t.spark, "texts")
    padded = F.concat(F.lit("  "), "text", F.lit('\n "quoted, twice" '))
    files.write_csv(t.documents.select("doc_id", F.lit("").alias("note"), padded.alias("text")), path, ["note", "text", "doc_id"], multi_line=True)
    return files.read_csv_typed(t.spark, path, "doc_id bigint, text string, note string", multi_line=True).na.fill("")


@query("SELECT doc_id, '  ' || text || chr(10) || ' \"quoted, twice\" ' AS text, '' AS note FROM documents")
def split_csv(t: Tables) -> DataFrame:
    """csv_roundtrip, with files that many tasks read though a field has many lines."""
    path = new_folder(t.spark, "texts")
    padded = F.concat(F.lit("  "), "text", F.lit('\n "quoted, twice" '))
    files.write_csv(t.documents.select("doc_id", F.lit("").alias("note"), padded.alias("text")), path, ["note", "text", "doc_id"], multi_line=True)
    sized = split.fair_range(t.spark, path)
    return files.read_csv_typed(t.spark, path, "doc_id bigint, text string, note string", range_bytes=sized).na.fill("")


def _late_misfits(t: Tables) -> str:
    """Columns of all types as text; two of them have one value in the last row that widens them."""
    path = new_folder(t.spark, "untyped")
    last = F.col("o_orderkey") == t.orders.select("o_orderkey").agg(F.max("o_orderkey")).scalar()
    text = t.orders.select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 10 != 3, F.round("o_totalprice").cast("bigint").cast("string")).alias("gapped"),
        F.when(last, "1.5").otherwise(F.col("o_custkey").cast("string")).alias("widened"),
        F.when(last, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("misfit"),
        F.lit(None).cast("string").alias("nothing"),
    )
    files.write_csv(text, path, text.columns)
    return path


_LATE = """late AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS key, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS status,
         CASE WHEN o_orderkey % 10 <> 3 THEN CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) END AS gapped,
         CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN '1.5' ELSE CAST(o_custkey AS VARCHAR) END AS widened,
         CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS misfit,
         CAST(NULL AS VARCHAR) AS nothing
  FROM orders)"""


@query(f"""
WITH {_LATE}, cells AS (
  SELECT unnest(['key', 'day', 'status', 'gapped', 'widened', 'misfit', 'nothing']) AS "column",
         unnest([key, day, status, gapped, widened, misfit, nothing]) AS v FROM late)
SELECT "column", CASE WHEN count(v) = 0 THEN 'null'
                      WHEN bool_and(regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS BIGINT) IS NOT NULL) FILTER (v IS NOT NULL) THEN 'bigint'
                      WHEN bool_and(regexp_full_match(v, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?')) THEN 'double'
                      WHEN bool_and(regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST(v AS DATE) IS NOT NULL) FILTER (v IS NOT NULL) THEN 'date'
                      ELSE 'string' END AS type, count(v) AS "values", count(*) - count(v) AS nulls
FROM cells GROUP BY 1""")
def csv_types(t: Tables) -> DataFrame:
    """The type of each column, from all values."""
    return types.value_types(files.read_csv_text(t.spark, _late_misfits(t), None), ["key", "day", "status", "gapped", "widened", "misfit", "nothing"])


@query(f"""
WITH {_LATE}
SELECT CAST(key AS BIGINT) AS key, CAST(day AS DATE) AS day, status, CAST(gapped AS BIGINT) AS gapped,
       CAST(widened AS DOUBLE) AS widened, misfit, nothing FROM late""")
def read_csv_inferred(t: Tables) -> DataFrame:
    return files.read_csv_inferred(t.spark, _late_misfits(t))


SALE_FIELDS = "date date, region string, amount bigint, category string"


def _sales_csv(t: Tables) -> str:
    """Whole amounts with a gap in every tenth row."""
    path = new_folder(t.spark, "sales")
    amount = F.when(F.col("sale_id") % 10 != 3, F.round("amount").cast("bigint"))
    files.write_csv(t.sales().withColumn("amount", amount), path, ["date", "region", "amount", "category"])
    return path


_GAPPED = f"""{SALES}, gapped AS (
  SELECT date, region, CASE WHEN sale_id % 10 <> 3 THEN CAST(round(amount) AS BIGINT) END AS amount, category
  FROM sales)"""


@query(f"WITH {_GAPPED} SELECT * FROM gapped")
def read_csv_typed(t: Tables) -> DataFrame:
    return files.read_csv_typed(t.spark, _sales_csv(t), SALE_FIELDS)


@query(f"""
WITH {_GAPPED}
SELECT category, SUM(CAST(amount AS DOUBLE)) AS total, COUNT(*) AS cnt
FROM gapped WHERE region = '2-HIGH' AND amount > 0 GROUP BY category""")
def read_csv_override(t: Tables) -> DataFrame:
    """The lazy chain: scan with one type replaced, filter twice, group, sort."""
    sales = files.read_csv_typed(t.spark, _sales_csv(t), SALE_FIELDS, {"amount": "double"})
    return (
        sales.filter(F.col("region") == "2-HIGH")
        .filter(F.col("amount") > 0)
        .groupBy("category")
        .agg(money_sum("amount").cast("double").alias("total"), F.count("*").alias("cnt"))
        .orderBy(F.desc("total"), "category")
    )


@query("SELECT c_mktsegment AS region, c_name AS month, c_acctbal AS amount, c_nationkey AS category FROM customer")
def write_csv_columns(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "columns")
    renamed = t.customer.select(
        F.col("c_acctbal").alias("amount"),
        F.col("c_nationkey").alias("category"),
        F.col("c_name").alias("month"),
        F.col("c_mktsegment").alias("region"),
    )
    files.write_csv(renamed, path, ["region", "month", "amount", "category"])
    return files.read_csv_typed(t.spark, path, "region string, month string, amount double, category int")


@query("""
SELECT c_custkey AS row, 'c_acctbal: must be a number greater than 0' AS error
FROM customer WHERE NOT c_acctbal > 0""")
def write_json_errors(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "errors")
    files.write_json_lines(error_rows(judged(t.customer, [positive_number("c_acctbal")]), "c_custkey"), path)
    return t.spark.read.schema("row bigint, error string").json(path)


@query("""
SELECT c_custkey // 500 AS part, CAST(c_custkey % 500 AS INTEGER) AS row, c_mktsegment AS region, c_acctbal AS amount,
       CASE WHEN c_acctbal > 0 THEN '' ELSE 'amount: must be a number greater than 0' END AS error
FROM customer""")
def judged_json(t: Tables) -> DataFrame:
    """Records that keep their own JSON types; every third amount is text that reads as a number."""
    path = new_folder(t.spark, "records")
    part = F.floor(F.col("c_custkey") / ARRAY_ROWS).cast("string")

    def record(amount):
        return F.to_json(
            F.struct(F.col("c_mktsegment").alias("region"), part.alias("month"), amount.alias("amount"))
        )

    text = F.when(F.col("c_custkey") % 3 == 0, record(F.col("c_acctbal").cast("string"))).otherwise(
        record(F.col("c_acctbal"))
    )
    files.array_lines(t.customer, part, "c_custkey", text).write.text(path)
    checked = judged_records(files.read_json_records(t.spark, path, whole_file=False))
    return checked.select(
        F.col("month").cast("bigint").alias("part"), "row", "region", "amount", F.array_join("errors", "; ").alias("error")
    )


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem")
def parquet_roundtrip(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    return tables.rewritten(rows, new_folder(t.spark, "lines"))


_BY_STATUS = f"SELECT o_orderstatus AS category, {total('o_totalprice')} AS total, COUNT(*) AS cnt FROM {{}} GROUP BY 1"


@query(_BY_STATUS.format("orders WHERE o_totalprice > 0"))
def sql_over_file(t: Tables) -> DataFrame:
    return tables.sql_over(t.spark, t.path("orders"), _BY_STATUS.format("{source} WHERE o_totalprice > 0"))


@query(f"WITH {_GAPPED} SELECT region, SUM(CAST(amount AS DOUBLE)) AS total, COUNT(*) AS cnt FROM gapped WHERE amount > 0 GROUP BY region")
def sql_over_csv_view(t: Tables) -> DataFrame:
    name = tables.own_name("sales_csv")
    tables.csv_view(t.spark, name, _sales_csv(t), SALE_FIELDS)
    return t.spark.sql(
        "SELECT region, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total, COUNT(*) AS cnt"
        f" FROM {name} WHERE amount > 0 GROUP BY region"
    )


@query("SELECT o_orderkey, o_custkey FROM orders")
def missing_file_skipped(t: Tables) -> DataFrame:
    """Of two sources only one is there."""
    paths = [t.path("orders"), t.path("orders_that_never_came")]
    found = [t.spark.read.parquet(p) if files.is_there(t.spark, p) else None for p in paths]
    present = [df.select("o_orderkey", "o_custkey") for df in found if df is not None]
    out = present[0]
    for df in present[1:]:
        out = out.unionByName(df)
    return out


@query("SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1")
def table_reloaded(t: Tables) -> DataFrame:
    """Writing the same table twice leaves one copy."""
    path = new_folder(t.spark, "reloaded")
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    tables.rewritten(counts, path)
    return tables.rewritten(counts, path)


@query("SELECT COUNT(*) AS written, COUNT(*) AS reloaded, TRUE AS same FROM customer WHERE c_acctbal > 0")
def reload_count(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "valid")
    valid = valid_rows(judged(t.customer, [positive_number("c_acctbal")]))
    files.write_csv(valid, path, CUSTOMER_COLUMNS)
    return files.reload_matches(valid, files.read_csv_text(t.spark, path, CUSTOMER_COLUMNS))


@query(f"WITH {SALES} SELECT region, {total('amount')} AS total, {total('amount')} / COUNT(amount) AS avg, COUNT(*) AS cnt FROM sales GROUP BY region")
def sales_view(t: Tables) -> DataFrame:
    return totals_by(tables.view(t.sales(), tables.own_name("sales")), ["region"], "amount")


@query("""
SELECT COUNT(*) AS records, COUNT(*) FILTER (c_acctbal > 0) AS valid, COUNT(*) FILTER (NOT c_acctbal > 0) AS refused,
       COUNT(*) FILTER (c_acctbal > 0) AS valid_again, COUNT(*) FILTER (NOT c_acctbal > 0) AS refused_again, TRUE AS agrees
FROM customer""")
def load_to_reload(t: Tables) -> DataFrame:
    """JSON records are loaded and judged; what is valid goes to CSV, the errors to JSON; both are read back and counted."""
    part = F.floor(F.col("c_custkey") / ARRAY_ROWS).cast("string")
    record = F.to_json(F.struct(F.col("c_name").alias("region"), part.alias("month"), F.col("c_acctbal").alias("amount")))
    source = new_folder(t.spark, "to-load")
    files.array_lines(t.customer, part, "c_custkey", record).write.text(source)
    checked = written(judged_records(files.read_json_records(t.spark, source, whole_file=False)), "judged")
    valid, errors = new_folder(t.spark, "valid"), new_folder(t.spark, "errors")
    files.write_csv(valid_rows(checked), valid, ["region", "month", "amount"])
    files.write_json_lines(error_rows(checked, "row"), errors)
    counts = checked.agg(
        F.count("*").alias("records"), F.count_if(F.size("errors") == 0).alias("valid"), F.count_if(F.size("errors") > 0).alias("refused")
    )
    back = files.read_csv_typed(t.spark, valid, "region string, month string, amount double")
    again = t.spark.read.schema("row bigint, error string").json(errors)
    return (
        counts.withColumn("valid_again", back.agg(F.count("*")).scalar())
        .withColumn("refused_again", again.agg(F.count("*")).scalar())
        .withColumn("agrees", (F.col("valid") == F.col("valid_again")) & (F.col("refused") == F.col("refused_again")))
    )
