"""Left outer lookup of a dimension, for dimensions of any size and facts with hot keys."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Largest dimension sent whole to every executor.
BROADCAST_BYTES = 96 * 1024 * 1024

# Largest part of a dimension that one task of a shuffled lookup holds in a hash table; beyond it
# both sides are sorted.
BUILD_BYTES = 128 * 1024 * 1024

# A key is hot if more than this share of the fact rows holds it: at most 100,000 keys are hot, and
# no other key brings more than a gigabyte of a 100 TB fact to one task.
HOT_SHARE = 0.00001

# A hot key is dealt over so many tasks for each task's share of the fact that it makes up.
DEALS = 16

# A hot key's line in the list that every executor gets: a hash and a number, whatever the key is.
LISTED_BYTES = 64


class DuplicateKeys(ValueError):
    """A dimension names a key more than once, which would multiply fact rows."""


@dataclass(frozen=True)
class Profile:
    """Measured size of a dimension and how many of its keys repeat."""

    bytes: int
    repeated_keys: int
    largest_row: int = 0

    def fits_broadcast(self, limit: int = BROADCAST_BYTES) -> bool:
        return self.bytes <= limit


def profile(dimensions: Mapping[str, DataFrame]) -> dict[str, Profile]:
    """Measure dimensions, given by their key column, in one job that returns one row each."""

    def measured(key: str, dimension: DataFrame) -> DataFrame:
        # In memory a row holds a header, one word per column, and the text itself.
        words = F.lit(16 + 16 * len(dimension.columns)).cast("long")
        row_bytes = reduce(
            lambda total, name: total + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)),
            dimension.columns,
            words,
        )
        keys = dimension.groupBy(key).agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(row_bytes).alias("bytes"),
            F.max(row_bytes).alias("largest"),
        )
        return keys.agg(
            F.lit(key).alias("key"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.count_if((F.col("rows") > 1) & F.col(key).isNotNull()).alias("repeated_keys"),
            F.coalesce(F.max("largest"), F.lit(0)).alias("largest"),
        )

    frames = [measured(key, dimension) for key, dimension in dimensions.items()]
    rows = reduce(DataFrame.unionByName, frames).collect()
    return {row["key"]: Profile(row["bytes"], row["repeated_keys"], row["largest"]) for row in rows}


def require_unique(measured: Mapping[str, Profile]) -> None:
    for key, one in measured.items():
        if one.repeated_keys:
            raise DuplicateKeys(f"{one.repeated_keys} values of {key} repeat in the dimension")


def _hot_keys(rows: DataFrame, key: str, hot_share: float) -> DataFrame:
    """Keys above the hot share with their share, as ``_hot`` and ``_share``; fewer than ``1 / hot_share``."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    all_rows = counts.agg(F.sum("rows")).scalar()
    hot = counts.filter(F.col("rows") > all_rows * F.lit(hot_share))
    return hot.select(F.col(key).alias("_hot"), (F.col("rows") / all_rows).alias("_share"))


def _deals(rows: DataFrame, key: str, hot_share: float, tasks: int) -> DataFrame:
    """Over how many deals a hot key goes (``_deals``), by the hash of the key (``_hash``).

    Another key of the same hash is dealt, too, on both sides of the lookup, so nothing is lost.
    """
    deals = F.ceil(F.col("_share") * (DEALS * tasks)).cast("long")
    hot = _hot_keys(rows, key, hot_share)
    listed = hot.groupBy(F.xxhash64("_hot").alias("_hash")).agg(F.max(deals).alias("_deals"))
    return listed.filter(F.col("_deals") > 1)


def _own_hash(fact: DataFrame) -> Column:
    return F.xxhash64(*fact.columns, F.spark_partition_id())


def with_spread(fact: DataFrame, name: str) -> DataFrame:
    """Add a hash of each row and its partition, for lookups one after the other."""
    return fact.withColumn(name, _own_hash(fact))


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    measured: Profile,
    broadcast_limit: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
    hot_share: float = HOT_SHARE,
    spread: str | None = None,
) -> DataFrame:
    """Every fact row with the dimension's columns, which are null where the key has no match.

    A dimension within the limit is broadcast, so the fact is not shuffled. For a larger one both
    sides are shuffled by key and deal. Rows of a hot key would pile up in one task: they are dealt
    over several, as many as the key's share of the fact asks for, and its dimension row is copied
    to each deal, so no dimension row is broadcast, however wide. Copies stay few: with the shares
    adding up to one at most, ``DEALS`` per task and one per hot key. Rows without a key are spread
    over all tasks. What is broadcast is the list of hot keys' hashes, of fewer than ``1 / hot_share``
    lines.

    A row's deal is taken from a hash of the row and its partition, so equal rows are dealt, too.
    ``spread`` names a column of the fact that holds such a hash already (see ``with_spread``); then
    the columns that nobody asks for are not shuffled. Keys are counted on ``counted``, a cheaper
    table with the same keys, or else on the fact.
    """
    if hot_share <= 0:
        raise ValueError("hot_share must be above zero: it bounds the number of hot keys")
    if LISTED_BYTES / hot_share > BROADCAST_BYTES:
        raise ValueError(f"hot_share {hot_share} makes the list of hot keys too large to broadcast")
    if fact.select(key).dtypes != dimension.select(key).dtypes:
        raise TypeError(f"{key} has another type in the dimension than in the fact")
    require_unique({key: measured})
    if measured.fits_broadcast(broadcast_limit):
        return fact.join(F.broadcast(dimension), key, "left")

    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [name for name in dimension.columns if name != key]
    deals = F.broadcast(_deals(fact if counted is None else counted, key, hot_share, tasks))
    # Fixed for each row, so that a task that is run again sends its rows to the same places.
    own = F.col(spread) if spread else _own_hash(fact)
    deal = F.when(F.col(key).isNull(), own).when(F.col("_deals").isNull(), F.lit(0)).otherwise(
        F.pmod(own, F.col("_deals"))
    )
    dealt = fact.join(deals, F.xxhash64(F.col(key)) == F.col("_hash"), "left").withColumn("_deal", deal)
    keyed = dimension.withColumnRenamed(key, "_key").filter(F.col("_key").isNotNull())
    copied = keyed.join(deals, F.xxhash64("_key") == F.col("_hash"), "left").select(
        "_key",
        *columns,
        F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_deals", F.lit(1)) - F.lit(1).cast("long"))).alias("_at"),
    )
    # (key, deal) is unique in the copies, so they spread evenly and the fact need not be sorted.
    most = measured.bytes + measured.largest_row * int(DEALS * tasks + 1 / hot_share)
    joined = dealt.join(
        copied.hint("shuffle_hash" if most <= tasks * BUILD_BYTES else "merge"),
        (F.col(key) == F.col("_key")) & (F.col("_deal") == F.col("_at")),
        "left",
    )
    return joined.select(*fact.columns, *columns)
