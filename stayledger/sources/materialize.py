"""Frames that several steps need."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def checkpoint_folder(spark: SparkSession, folder: str | None = None) -> str:
    """The given folder, or the one the cluster names for checkpoints; all executors must share it."""
    named = folder or spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share, or name one")
    return named


def materialized(frame: DataFrame, folder: str | None = None) -> DataFrame:
    """Compute a frame once, into Parquet files that outlive any executor and know their size."""
    return _written(frame, _path(frame.sparkSession, folder))


@contextmanager
def materialized_while(frame: DataFrame, folder: str | None = None) -> Iterator[DataFrame]:
    """The same for the length of a block; its files are removed afterwards, also if the block fails."""
    path = _path(frame.sparkSession, folder)
    try:
        yield _written(frame, path)
    finally:
        remove(frame.sparkSession, path)


def _path(spark: SparkSession, folder: str | None) -> str:
    return f"{checkpoint_folder(spark, folder)}/stayledger-{uuid.uuid4().hex}"


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder from the file system that its path names, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
