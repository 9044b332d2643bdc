"""Session settings and lineage cutting."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot join keys are split at run time from the measured shuffle sizes
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(app: str = "layerlake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the one the session names, or a scratch one in local mode.

    On a cluster the folder must be shared storage, so an unset folder is an error there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="layerlake-checkpoint-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    context.setCheckpointDir(configured)
    return configured


_recording: list[list[str]] = []


@contextlib.contextmanager
def intermediate(spark: SparkSession) -> Iterator[list[str]]:
    """Folders of tables stored inside, in order; they are deleted at the end, but for those taken off the list.

    For work whose result is itself stored inside: nothing reads the others any more.
    """
    made: list[str] = []
    _recording.append(made)
    try:
        yield made
    finally:
        _recording.pop()
        drop(spark, made)


def drop(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once, as Parquet in the shared checkpoint folder, and continue from that copy.

    Used where several branches must see the very same rows in the very same
    partitions, or would repeat costly work. The stored copy survives the loss
    of executors; a cached one would not. The folder belongs to the application
    and can be removed when it ends, or by ``intermediate``.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    for made in _recording:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
