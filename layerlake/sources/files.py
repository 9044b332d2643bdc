"""File scans. Files go from storage to executors; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import flatten_structs

INGESTED_AT, SOURCE_FILE, CORRUPT = "_ingested_at", "_source_file", "_corrupt_record"


@dataclass(frozen=True)
class FileSource:
    """Where a raw table comes from. ``schema`` avoids inference and fixes the types."""

    path: str
    format: str = "parquet"
    schema: T.StructType | str | None = None
    options: Mapping[str, str] | None = None


def read_source(spark: SparkSession, source: FileSource) -> DataFrame:
    reader = spark.read.format(source.format)
    if source.schema is not None:
        reader = reader.schema(source.schema)
    return reader.options(**dict(source.options or {})).load(source.path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return read_source(spark, FileSource(path, "parquet", schema))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and declared types; a value that does not fit fails the read."""
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST", enforceSchema=False)


def read_csv_with_quarantine(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected raw lines) of a CSV with declared types."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = spark.read.csv(
        path, schema=wide, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )
    # Spark refuses to read the reject column alone, even for a count, so the
    # filter also looks at the typed columns; the length is never negative.
    typed = F.concat_ws("", *[F.col(f"`{f.name}`").cast("string") for f in schema.fields])
    bad = F.col(CORRUPT).isNotNull() & (F.length(typed) >= 0)
    return parsed.where(~bad).drop(CORRUPT), parsed.where(bad).select(CORRUPT)


def read_nested_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, *, multiline: bool = True
) -> DataFrame:
    """JSON objects with nested structs, flattened: ``a.b`` becomes ``a_b``.

    Set ``multiline=False`` for one object per line: only those files split.
    """
    return flatten_structs(spark.read.json(path, schema=schema, multiLine=multiline))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and modification time of the files under ``path``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select("path", "length", "modificationTime")


def with_ingest_columns(df: DataFrame) -> DataFrame:
    """Add when and from which file a row was read."""
    return df.withColumns({INGESTED_AT: F.current_timestamp(), SOURCE_FILE: F.col("_metadata.file_path")})


def without_ingest_columns(df: DataFrame) -> DataFrame:
    return df.drop(INGESTED_AT, SOURCE_FILE)


def read_modified_after(
    spark: SparkSession, source: FileSource, after: datetime
) -> DataFrame:
    """Only files changed after ``after`` (session time zone), for a batch incremental load."""
    options = {**dict(source.options or {}), "modifiedAfter": after.strftime("%Y-%m-%dT%H:%M:%S")}
    return read_source(spark, FileSource(source.path, source.format, source.schema, options))


def land_raw_copy(spark: SparkSession, source: FileSource, target: str) -> DataFrame:
    """Store the source unchanged as Parquet and return the stored copy."""
    read_source(spark, source).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def ingest_all(spark: SparkSession, sources: Mapping[str, FileSource], namespace: str) -> list[str]:
    """Overwrite one table per source, in the namespace; rerunning gives the same tables."""
    from ..sinks.tables import create_namespace, overwrite_table

    create_namespace(spark, namespace)
    for name, source in sources.items():
        overwrite_table(read_source(spark, source), f"{namespace}.{name}")
    return list(sources)
