"""Parquet tables, SQL over files, views and small literal tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import path_bytes, size_hash_tables


# Declared types, so that no job has to look into the files first.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


@dataclass(frozen=True)
class Tables:
    """The Parquet tables of one folder, by attribute."""

    spark: SparkSession
    folder: str
    sizes: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        size_hash_tables(self.spark, 0)

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self.sizes:  # shuffles are sized by the tables that a query reads
            self.sizes[name] = path_bytes(self.spark, self.path(name))
            size_hash_tables(self.spark, sum(self.sizes.values()))
        reader = self.spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else self.spark.read
        return reader.parquet(self.path(name))

    def sales(self) -> DataFrame:
        """Orders in the role of sales records."""
        return self.orders.select(
            F.col("o_orderkey").alias("sale_id"),
            F.to_date("o_orderdate").alias("date"),
            F.date_format("o_orderdate", "yyyy-MM").alias("month"),
            F.col("o_orderpriority").alias("region"),
            F.col("o_orderstatus").alias("category"),
            F.col("o_totalprice").alias("amount"),
        )

    def usage(self) -> DataFrame:
        """Orders in the role of a usage log: one row per use, with many months per key."""
        return self.orders.select(
            F.col("o_orderkey").alias("usage_id"),
            F.col("o_custkey").alias("sub_id"),
            F.col("o_orderdate").alias("use_dt"),
            F.col("o_totalprice").alias("mb"),
        )

    def active(self) -> DataFrame:
        """Returned line items in the role of active subscriptions."""
        return self.lineitem.filter(F.col("l_returnflag") == "R")


def sql_over(spark: SparkSession, path: str, sql: str, file_format: str = "parquet") -> DataFrame:
    """Run SQL in which {source} stands for the file."""
    quoted = path.replace("`", "``")
    return spark.sql(sql.format(source=f"{file_format}.`{quoted}`"))


def csv_view(spark: SparkSession, name: str, path: str, schema: str, multi_line: bool = False) -> None:
    """A view over CSV files, whose headers have to name the columns in the order of `schema`."""
    quoted = path.replace("'", "\\'")
    options = f"header 'true', escape '\"', enforceSchema 'false', multiLine '{str(multi_line).lower()}'"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} ({schema}) USING csv OPTIONS (path '{quoted}', {options})")


def own_name(label: str) -> str:
    """A view's name that no other query of the session uses."""
    return f"{label}_{uuid.uuid4().hex}"


def view(df: DataFrame, name: str) -> DataFrame:
    """Name a query and read it back by that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def rewritten(df: DataFrame, path: str) -> DataFrame:
    """Replace whatever the path holds and read it back; running it again changes nothing."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reload_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Drop and create a catalog table from `df`, its files under `path` if one is given."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)
