"""Catalog tables: namespaces, idempotent overwrite, layout, comments, checked append, export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_namespace(spark: SparkSession, namespace: str, comment: str = "") -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(namespace)} COMMENT {_text(comment)}")


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range-partition and sort by the columns, so that file and row-group ranges can be skipped."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns) if columns else df


def overwrite_table(df: DataFrame, name: str, *, cluster_by: Sequence[str] = (), comment: str | None = None) -> None:
    """Create or replace the table, with whatever schema ``df`` has now."""
    clustered(df, cluster_by).write.format("parquet").mode("overwrite").saveAsTable(name)
    if comment is not None:
        comment_table(df.sparkSession, name, comment)


def overwrite_table_counted(df: DataFrame, name: str) -> int:
    """Overwrite and return the number of rows written, counted during the write itself."""
    seen = Observation()
    overwrite_table(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return seen.get["n"]


def table_from_query(spark: SparkSession, name: str, query: str, **values) -> None:
    """Create or replace the table from a query with named parameters."""
    overwrite_table(spark.sql(query, values), name)


def comment_table(spark: SparkSession, name: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {_quoted(name)} IS {_text(comment)}")


def comment_columns(spark: SparkSession, name: str, comments: Mapping[str, str]) -> None:
    for column, comment in comments.items():
        spark.sql(f"ALTER TABLE {_quoted(name)} ALTER COLUMN `{column}` COMMENT {_text(comment)}")


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments to the frame; they are stored with it when it is written."""
    for column, comment in comments.items():
        df = df.withMetadata(column, {"comment": comment})
    return df


_WIDTH = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def _fits(source: T.DataType, target: T.DataType) -> bool:
    """True when every value of ``source`` can be stored as ``target`` without loss."""
    if source == target or isinstance(source, T.NullType):
        return True
    if isinstance(source, T.FloatType) and isinstance(target, T.DoubleType):
        return True
    if type(source) in _WIDTH and type(target) in _WIDTH:
        return _WIDTH.index(type(source)) <= _WIDTH.index(type(target))
    if isinstance(target, T.DecimalType):
        if isinstance(source, T.DecimalType):
            whole = target.precision - target.scale >= source.precision - source.scale
            return whole and target.scale >= source.scale
        digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}.get(type(source))
        return digits is not None and target.precision - target.scale >= digits
    return False


def checked_for(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``schema``; an unsafe type or a wrong column is refused."""
    missing = sorted(set(schema.names) - set(df.columns))
    extra = sorted(set(df.columns) - set(schema.names))
    if missing or extra:
        raise TypeError(f"columns do not match: missing {missing}, unexpected {extra}")
    for field in schema.fields:
        given = df.schema[field.name].dataType
        if not _fits(given, field.dataType):
            raise TypeError(f"{field.name}: {given.simpleString()} does not fit {field.dataType.simpleString()}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def append_rows(df: DataFrame, name: str) -> None:
    """Append after checking the types against the table; the table is untouched on a mismatch."""
    checked_for(df, df.sparkSession.table(name).schema).write.mode("append").insertInto(name)


def export_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
