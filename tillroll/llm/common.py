"""Helpers that several operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.storage import new_folder, remove, remove_at_end

# The white space that separates words, as characters and as a Java pattern.
SPACES = " \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The folders of working tables that the operator being run has made.
_made: ContextVar[list[str] | None] = ContextVar("working tables", default=None)


def noted(spark: SparkSession, path: str) -> None:
    """A folder just written goes with its operator (see ``finished``), or when the application ends."""
    remove_at_end(spark, path)
    if (made := _made.get()) is not None:
        made.append(path)


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write a table once below the shared folder and read it from there: it outlives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    noted(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession) -> None:
    """Let the shuffle files of work that is done go from the executors' disks, which they do when the
    driver's garbage is collected: by itself, every half hour."""
    gc.collect()
    spark._jvm.System.gc()


def unstaged(df: DataFrame) -> None:
    """Remove a staged table that nothing reads any more, and the shuffle files behind it."""
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        remove(df.sparkSession, folder)
    freed(df.sparkSession)


def finished(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, written; the working tables made for it are removed, also after a failure."""
    made: list[str] = []
    outer = _made.set(made)
    try:
        df = build()
        path = new_folder(spark, name)
        df.write.parquet(path)
        result = spark.read.schema(df.schema).parquet(path)
    finally:
        _made.reset(outer)
        for folder in made:
            remove(spark, folder)
        freed(spark)
    noted(spark, path)
    return result


def shielded(df: DataFrame, read: Sequence[str], given: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns renamed but those that are read, so that no working column meets one of
    the same name; and how to get a result's columns back. Columns that the result gives are left out.
    """
    others = [name for name in df.columns if name not in {*read, *given}]
    own = {f"_other{k}": name for k, name in enumerate(others)}
    inner = df.select(*read, *(F.col(f"`{name}`").alias(hidden) for hidden, name in own.items()))

    def restored(result: DataFrame) -> DataFrame:
        shown = {name: hidden for hidden, name in own.items()}
        first = [name for name in df.columns if name in shown or name in result.columns]
        last = [name for name in result.columns if name not in own and name not in first]
        return result.select(*(F.col(shown.get(name, f"`{name}`")).alias(name) for name in [*first, *last]))

    return inner, restored


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_PATTERN)
    )


def same(left: Column, right: Column) -> Column:
    """Equality that also holds between nulls."""
    return left.eqNullSafe(right)


def row_chunks(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``text`` has ``limit`` bytes at most, or one row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def byte_chunks(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with the UTF-8 bytes of their ``text``, of ``limit`` bytes or one row each."""
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    start, held = 0, 0
    for i, text in enumerate(texts):
        texts[i] = text or b""
        if held and held + len(texts[i]) > limit:
            yield batch.slice(start, i - start), texts[start:i]
            start, held = i, 0
        held += len(texts[i]) + 1
    if texts:
        yield batch.slice(start), texts[start:]
