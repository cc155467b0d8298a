"""Keeping a table for several uses."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"
WORK_FOLDER = "_tillroll_work"


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a table on the executors while the block runs, and release that same table after it.

    What a lost executor held is computed again from the source.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; else one below its warehouse."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get(WAREHOUSE_SETTING).rstrip('/')}/{WORK_FOLDER}").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table once as Parquet and read it from there.

    Takes the place of caching for a table larger than the cluster's memory: reports read only
    their columns, and a lost executor costs no recomputation.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have an existing folder removed when the application ends."""
    place, files = _place(spark, path)
    files.deleteOnExit(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is missing."""
    place, files = _place(spark, path)
    return [found.getPath().getName() for found in files.listStatus(place)] if files.exists(place) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file."""
    place, files = _place(spark, path)
    stream = files.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    place, files = _place(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def temporary(df: DataFrame, name: str) -> DataFrame:
    """``written`` below the shared folder, for as long as the application runs."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    kept = written(df, path)
    remove_at_end(spark, path)
    return kept


@contextmanager
def working_copy(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A table kept in the shared folder while the block runs; the copy is removed after it, also after a failure."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    try:
        yield written(df, path)
    finally:
        remove(spark, path)
