"""Ranks and top-k with ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tillroll.operators.ordering import rank_whole

# Spark's setting for the largest k that it cuts early.
LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _by_window(df: DataFrame, by: str, partition: Sequence[str], name: str) -> DataFrame:
    window = Window.partitionBy(*partition).orderBy(F.desc_nulls_last(by))
    return df.withColumn(name, F.rank().over(window))


def ranked(df: DataFrame, by: str, partition: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Add the rank by descending ``by``: equal values share a rank, gaps follow, nulls come last.

    Without a partition all rows compete; then the table is written once in order (``rank_whole``),
    because a window would bring all of it to one task.
    """
    return _by_window(df, by, partition, name) if partition else rank_whole(df, by, name)


def top_n(
    df: DataFrame,
    by: str,
    k: int,
    partition: Sequence[str] = (),
    drop_null_keys: Sequence[str] = (),
) -> DataFrame:
    """Rows ranked at most ``k`` in their partition; ties at the border are all kept.

    For k up to ``LIMIT`` Spark cuts each task's rows to the k best before they meet, so a partition's
    rows (or all rows, without a partition) are not gathered. Beyond it, without a partition, the
    k-th value is found first and only the rows at or above it are ranked. ``drop_null_keys`` names
    columns whose null group does not compete.
    """
    if drop_null_keys:
        df = df.dropna(subset=list(drop_null_keys))
    if not partition and k > int(df.sparkSession.conf.get(LIMIT)):
        best = df.select(F.col(by).alias("_best")).orderBy(F.desc_nulls_last("_best")).limit(k)
        # Nulls come last: one among the k best means that all rows with a value are, too.
        border = best.agg(F.when(F.count("_best") == k, F.min("_best"))).scalar()
        df = df.filter(border.isNull() | (F.col(by) >= border))
    return _by_window(df, by, partition, "_rank").filter(F.col("_rank") <= k).drop("_rank")
