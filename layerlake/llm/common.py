"""What several operators need: reading tables, batches to and from Python tasks, stored rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize as stored

__all__ = ["ARROW", "arrow_map", "free_name", "id_text", "read", "stored"]

#: Arrow types by the names used in schema strings.
ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` as long and ``text`` with null read as empty; other columns, whatever their names, are left out."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def arrow_map(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Each batch of columns through a Python function that runs where the rows are.

    ``make()`` is called once in each task and returns a function that takes
    the batch's columns as Arrow arrays and returns, or yields, tuples of
    output columns (lists or arrays, in the order of ``schema``).
    """
    fields = [part.strip().split(" ", 1) for part in schema.split(", ")]
    types = pa.schema([(name, ARROW[kind]) for name, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                for columns in work(*batch.columns):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) if not isinstance(c, pa.Array) else c.cast(t)
                         for c, t in zip(columns, types.types, strict=True)],
                        schema=types,
                    )

    return df.mapInArrow(run, schema)


def any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
