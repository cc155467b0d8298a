"""A Bloom filter of fixed size over a long column, whatever the number of its values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

FILTER_BITS = 23


def bloom(values: DataFrame, name: str) -> np.ndarray:
    """A filter of the hashes in ``name``: 64-bit words whose number is fixed."""
    low = F.lit((1 << FILTER_BITS) - 1)
    place = F.explode(
        F.array(F.col(name).bitwiseAND(low), F.shiftright(name, FILTER_BITS).bitwiseAND(low))
    )
    rows = (
        values.select(place.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(p & 63 AS INT)))").alias("bits"))
    )
    words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in rows.collect():  # as many rows as the filter has words, at most
        words[row["word"]] = row["bits"]
    return words


def contains(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each value whether the filter may hold it; never false for one that it holds."""
    low = (1 << FILTER_BITS) - 1
    found = np.ones(len(values), bool)
    for place in (values & low, (values >> FILTER_BITS) & low):
        found &= (words[place >> 6] >> (place & 63)) & 1 == 1
    return found


def passing(rows: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """The rows whose long ``name`` may be among the wanted: few enough to be joined with them."""
    shared = rows.sparkSession.sparkContext.broadcast(bloom(wanted, name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(contains(shared.value, batch.column(name).to_numpy())))

    return rows.mapInArrow(run, rows.schema)
