"""Cutting lineage in storage that outlives an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, set up once per session.

    The folder named by ``spark.checkpoint.dir`` is used. Only a local master
    without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="larder-checkpoint-")
    context.setCheckpointDir(named)
    return named


# Paths made inside each open ``pins_released`` of this thread or task, the innermost last.
_open_runs: ContextVar[tuple[list[str], ...]] = ContextVar("open_runs", default=())


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the checkpoint folder, for tables that a plan needs for a while.

    It is deleted when the application ends, or at the end of the ``pins_released``
    block around the call.
    """
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    files, place = _file_system(spark, path)
    files.mkdirs(place)  # what isn't there can't be marked for deletion
    files.deleteOnExit(place)
    if runs := _open_runs.get():
        runs[-1].append(path)
    return path


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to shared storage and read it back, so later steps see one fixed result.

    A written table survives lost executors like a checkpoint does, takes one
    pass instead of two, and is read back by column. It is deleted when the
    application ends, or at the end of the ``pins_released`` block around it.
    """
    spark = df.sparkSession
    path = scratch(spark, "pinned") + "/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def pins_released(spark: SparkSession) -> Iterator[None]:
    """Deletes what is pinned inside the block when it ends; results must be stored by then."""
    paths: list[str] = []
    before = _open_runs.set((*_open_runs.get(), paths))
    try:
        yield
    finally:
        _open_runs.reset(before)
        for path in paths:
            files, place = _file_system(spark, path)
            files.delete(place, True)
