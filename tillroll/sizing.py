"""Session settings that follow from the size of a delivery."""

from __future__ import annotations

from pyspark.sql import SparkSession

MIB = 1024 * 1024

# Scan tasks read 128 MiB each until there would be too many of them. A task's distinct keys must
# still fit its memory, also when it reads the same bytes of the much denser Parquet copy.
SMALLEST_SPLIT, LARGEST_SPLIT, MOST_SPLITS = 128 * MIB, 256 * MIB, 400_000

# The largest shuffle carries the transaction and collector keys, about a quarter of the input. More
# reducers would cost the driver more for keeping track of blocks than smaller tasks save.
SHUFFLED_SHARE = 0.25
REDUCER_BYTES, FEWEST_REDUCERS, MOST_REDUCERS = 256 * MIB, 200, 20_000


def settings_for(input_bytes: int) -> dict[str, str]:
    split = min(max(input_bytes // MOST_SPLITS, SMALLEST_SPLIT), LARGEST_SPLIT)
    reducers = int(input_bytes * SHUFFLED_SHARE / REDUCER_BYTES)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        # An upper bound: adaptive execution merges partitions that turn out small.
        "spark.sql.shuffle.partitions": str(min(max(reducers, FEWEST_REDUCERS), MOST_REDUCERS)),
    }


def apply(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Set what the session was not given explicitly; returns what was set."""
    given = spark.sparkContext.getConf()
    chosen = {name: value for name, value in settings_for(input_bytes).items() if not given.contains(name)}
    for name, value in chosen.items():
        spark.conf.set(name, value)
    return chosen
