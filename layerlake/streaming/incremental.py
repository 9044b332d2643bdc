"""Incremental file loads: each file is taken once, however often the job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import with_ingest_columns

BATCH = "batch_id"


def new_files(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A stream over the files of a folder, with ingest columns. The schema must be declared."""
    stream = spark.readStream.format(fmt).schema(schema).options(**options).load(path)
    return with_ingest_columns(stream)


def append_batch(batch: DataFrame, target: str, batch_id: int) -> int:
    """Write one micro-batch under its number; returns the rows written, 0 if it had been written before.

    The folder of a number is complete once it holds the marker that Spark
    writes last. A replay of a complete batch changes nothing; what an
    interrupted try left is replaced.
    """
    folder = f"{target}/{BATCH}={batch_id}"
    spark = batch.sparkSession
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
        return 0
    counted = Observation()
    batch.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder)
    return counted.get["n"]


def load_new_files(stream: DataFrame, target: str, checkpoint: str) -> int:
    """Append everything that arrived since the last call, then stop; returns the rows written by this call.

    The checkpoint remembers the files already taken and the batch numbers; each
    batch goes to a folder of its number. So a crashed or repeated run neither
    loses nor doubles a file. Rows are counted while they are written, whatever
    the number of batches. Readers of ``target`` see ``batch_id`` as a column.
    """
    written = []
    query = (
        stream.writeStream.foreachBatch(lambda batch, number: written.append(append_batch(batch, target, number)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(written)
