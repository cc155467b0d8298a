"""Places and ranks in the order of a whole table, without a task that holds the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillroll.operators.lookup import BROADCAST_BYTES, HOT_SHARE, lookup, profile
from tillroll.storage import temporary

# A row's number within its task's part of the order stands in so many bits, the part above them.
ROW_BITS = 33


def _orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def positioned(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Add each row's place in the given order: 1, 2, 3 and so on without gaps.

    Rows that the order leaves equal are placed by their columns, from the first to the last, each
    ascending with nulls first. The table is sorted by ranges of its rows, equal rows too, and written
    once in that order with each row's number within its range; a range's first place is the number of
    rows in the ranges before it. Only a number per range reaches the driver.
    """
    spark = df.sparkSession
    others = [F.col(field.name) for field in df.schema.fields if _orderable(field.dataType)]
    # The last key differs between all rows, so a range ends wherever it is full.
    placed = df.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*order, *others, "_tie")
    kept = temporary(placed.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "ordered")

    part = F.shiftright("_at", ROW_BITS)
    sizes = kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect()
    before, firsts = 0, []
    for size in sorted(sizes):
        firsts.append((size["part"], before))
        before += size["rows"]
    first = F.broadcast(spark.createDataFrame(firsts, "_part long, _before long"))
    row = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    joined = kept.join(first, part == F.col("_part"))
    return joined.select(*df.columns, (F.col("_before") + row + 1).alias(name))


def rank_whole(
    df: DataFrame,
    by: str,
    name: str = "rank",
    broadcast_limit: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Add the rank of each row by descending ``by`` among all rows: equal values share a rank, gaps
    follow, nulls come last.

    A value's rank is the first place of its rows. Values are looked up like the keys of a dimension,
    so a value that very many rows share is not gathered either.
    """
    placed = positioned(df, [F.desc_nulls_last(by)], "_position")
    known = placed.filter(F.col(by).isNotNull())
    ranks = known.groupBy(by).agg(F.min("_position").alias(name))
    last = F.lit(known.count() + 1)
    measured = profile({by: ranks})[by]
    ranked = lookup(placed.drop("_position"), ranks, by, measured, broadcast_limit, hot_share=hot_share)
    return ranked.select(*df.columns, F.coalesce(F.col(name), last).alias(name))
