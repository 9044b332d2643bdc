"""Scans of catalog tables and of what the catalog knows about them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMN_SCHEMA = "table_name string, column_name string, data_type string, comment string"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def namespace_reader(spark: SparkSession, namespace: str) -> Callable[[str], DataFrame]:
    """A reader of the tables of one namespace, so that names carry no catalog."""
    return lambda table: spark.read.table(f"{namespace}.{table}")


def query_table(spark: SparkSession, table: str, query: str, **values) -> DataFrame:
    """Run a query whose table is the named parameter ``:t`` inside ``IDENTIFIER(:t)``."""
    return spark.sql(query, {"t": table, **values})


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """The tables of the namespace; the session's temporary views are not part of it."""
    found = [t for t in spark.catalog.listTables(namespace) if not t.isTemporary]
    rows = [(t.name, t.tableType, t.description) for t in found]
    return spark.createDataFrame(rows, "table_name string, table_type string, comment string")


def describe_columns(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Name, type and comment of every column of the given tables."""
    rows = [
        (table, field.name, field.dataType.simpleString(), field.metadata.get("comment"))
        for table in tables
        for field in spark.table(table).schema.fields
    ]
    return spark.createDataFrame(rows, COLUMN_SCHEMA)


def undocumented_columns(
    spark: SparkSession, namespace: str, internal_prefix: str = "__"
) -> DataFrame:
    """Columns without a comment in the namespace; tables with the internal prefix are left out."""
    names = [
        f"{namespace}.{t.name}"
        for t in spark.catalog.listTables(namespace)
        if not t.isTemporary and not t.name.startswith(internal_prefix)
    ]
    columns = describe_columns(spark, names)
    return columns.where(F.trim(F.coalesce("comment", F.lit(""))) == "")
