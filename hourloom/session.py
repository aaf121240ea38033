"""Session settings and the small helpers that need a session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Largest table, in rows, that a join may broadcast.  Such rows are a group's key and two numbers
#: wide, so this stays near 10 MB on each executor.
BROADCAST_ROWS = 100_000


def configure(spark: SparkSession) -> SparkSession:
    """All timestamps are UTC: a local zone with summer time would merge two hours into one."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def is_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows; counting stops right after the limit."""
    return df.limit(limit + 1).count() <= limit


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; a fresh temporary one only on a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", "")
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
            folder = tempfile.mkdtemp(prefix="hourloom-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and cut its lineage.

    For narrow tables that are read as a whole.  A lost executor then costs a re-read of a file and not a rebuild.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _write_new(df: DataFrame, name: str) -> str:
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a new Parquet table in the checkpoint folder: readers fetch only the columns they use."""
    return df.sparkSession.read.parquet(_write_new(df, name))


@contextmanager
def stored_meanwhile(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As :func:`stored`; the table is removed at the end of the block."""
    path, context = _write_new(df, name), df.sparkSession.sparkContext
    try:
        yield df.sparkSession.read.parquet(path)
    finally:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
