"""Versioned tables: every write is a new version; any version can be read or restored.

A version is a list of Parquet folders plus a schema, recorded as one row of a
small log next to them. A write lands in a fresh folder first and becomes
visible only with its log row. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import conditional_set
from .tables import checked_for

LOG_SCHEMA = (
    "version bigint, operation string, folders array<string>, schema string, comment string, "
    "measures map<string,string>, committed_at timestamp"
)


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def history(self) -> DataFrame:
        """One row per version."""
        try:
            return self.spark.read.schema(LOG_SCHEMA).json(f"{self.path}/log")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def current_version(self) -> int | None:
        return self.history().agg(F.max("version")).first()[0]

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of ``version``, or as it is now."""
        entry = self._entry(version)
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in entry["folders"]])

    def stage(self, df: DataFrame) -> str:
        """Write the rows to a fresh folder without publishing them; returns its name."""
        folder = f"data/{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        return folder

    def discard(self, folder: str) -> None:
        """Delete a staged folder that will not be published."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def comment(self) -> str | None:
        """What the newest version says about the table."""
        return self._entry(None)["comment"]

    def measures(self, version: int | None = None) -> dict[str, Decimal] | None:
        """What was measured while the version was written, or None if nothing was."""
        found = self._entry(version)["measures"]
        return None if found is None else {name: None if v is None else Decimal(v) for name, v in found.items()}

    def publish(
        self, folders: list[str], schema: T.StructType, operation: str, comment: str | None = None,
        measures: Mapping[str, Decimal | int | None] | None = None,
    ) -> int:
        """Make the folders the newest version; without a comment the one of the version before stays.

        ``measures`` are numbers about the rows of the version, kept with it.
        """
        newest = self.history().orderBy(F.desc("version")).first()
        version = 0 if newest is None else newest["version"] + 1
        if comment is None and newest is not None:
            comment = newest["comment"]
        entry = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"),
            F.lit(operation).alias("operation"),
            F.array(*[F.lit(f) for f in folders]).alias("folders"),
            F.lit(schema.json()).alias("schema"),
            F.lit(comment).cast("string").alias("comment"),
            _map_of(measures).alias("measures"),
            F.current_timestamp().alias("committed_at"),
        )
        entry.coalesce(1).write.mode("append").json(f"{self.path}/log")
        return version

    def overwrite(self, df: DataFrame, operation: str = "OVERWRITE") -> int:
        """Replace the contents; the schema may change. Earlier versions stay readable."""
        return self.publish([self.stage(df)], df.schema, operation)

    def append(self, df: DataFrame) -> int:
        """Add rows of the current schema. Only the new rows are written."""
        entry = self._entry(None)
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        folder = self.stage(checked_for(df, schema))
        return self.publish([*entry["folders"], folder], schema, "APPEND")

    def update(self, column: str, value, where: Column) -> int:
        """Set ``column`` to ``value`` where the condition holds, as a new version."""
        now = self.read()
        return self.overwrite(conditional_set(now, column, value, where), "UPDATE")

    def restore(self, version: int) -> int:
        """Make an earlier version current again, as a new version that shares its folders."""
        entry = self._entry(version)
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        return self.publish(list(entry["folders"]), schema, f"RESTORE {version}", measures=self.measures(version))

    def _entry(self, version: int | None):
        log = self.history()
        wanted = log.orderBy(F.desc("version")) if version is None else log.where(F.col("version") == version)
        entry = wanted.first()
        if entry is None:
            raise LookupError(f"{self.path} has no version {'yet' if version is None else version}")
        return entry


def _map_of(measures: Mapping | None) -> Column:
    if measures is None:
        return F.lit(None).cast("map<string,string>")
    return F.create_map(*[F.lit(x).cast("string") for name, v in measures.items() for x in (name, None if v is None else str(v))])
