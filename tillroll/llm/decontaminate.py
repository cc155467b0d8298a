"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly.

An item is far smaller than the documents that may hold it, so whole documents are no good partners
for MinHash. Items are partitioned by the size of their shingle set, to powers of two; for each
partition the shingles of a document are cut into segments of twice that size. The similarity of
an item to a segment that holds it is then bounded from below whatever the document's length. A
document is a candidate for an item where one of its segments has one of the item's ``HASHES``
minima. A minimum of the item is a shingle that the document holds with a probability of at
least 0.75, and it is the minimum of its segment with one of at least 1/4, so a contained item is
missed with a probability below 0.81 ** 64, also where its parts are scattered.

Segments' minima meet the items' by a join. A Bloom filter of fixed size, whatever the size of the
benchmark, keeps minima that no item has out of that shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.bloom import bloom, contains
from tillroll.llm.common import byte_chunks, same, staged
from tillroll.llm.shingles import CHUNK, U, mixed, seeds, shingle_hashes, shingle_sets

HASHES = 64
PERCENT = 75

_FLIPS, _TIMES = seeds(HASHES, 11)


def _partition(size: int) -> int:
    """The smallest power of two, as exponent, that holds a set of this size."""
    return max(int(size) - 1, 0).bit_length()


def _key(least: np.ndarray, k: int, partition: int) -> np.ndarray:
    salt = (k * 64 + partition) * 0x9E3779B97F4A7C15 % (1 << 64)
    return mixed(least + U(salt)).view(np.int64)


def _item_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, n, partition, shingles, keys) of items that have words."""
    for batch in batches:
        for rows, texts in byte_chunks(batch, CHUNK):
            for i, found in enumerate(shingle_sets(texts)):
                if not len(found):
                    continue
                part = _partition(len(found))
                keys = [
                    _key(((found ^ c) * m).min(keepdims=True), k, part)[0]
                    for k, (c, m) in enumerate(zip(_FLIPS, _TIMES, strict=True))
                ]
                columns = [
                    rows.column("item_id").slice(i, 1),
                    pa.array([len(found)], pa.int64()),
                    pa.array([part], pa.int32()),
                    pa.array([found.view(np.int64)], pa.list_(pa.int64())),
                    pa.array([keys], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["item_id", "n", "partition", "shingles", "keys"]
                )


def _segment_keys(words, partitions: list[int]) -> Callable:
    """Rows (doc_id, key, met): minima of a document's segments that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = words.value
        for batch in batches:
            for rows, texts in byte_chunks(batch, CHUNK):
                hashes, sizes = shingle_hashes(texts)
                if not len(hashes):
                    continue
                offsets = np.cumsum(sizes) - sizes
                cuts = []
                for part in partitions:
                    n = -(-sizes // (2 << part))
                    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                    row = np.repeat(np.arange(len(sizes)), n)
                    cuts.append((part, row, offsets[row] + within * (2 << part)))
                hit_rows, hits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for k, (flip, times) in enumerate(zip(_FLIPS, _TIMES, strict=True)):
                    values = (hashes ^ flip) * times
                    for part, row, starts in cuts:
                        keys = _key(np.minimum.reduceat(values, starts), k, part)
                        found = contains(listed, keys)
                        hit_rows.append(row[found])
                        hits.append(keys[found])
                yield _rows(rows, np.concatenate(hit_rows), np.concatenate(hits))

    return run


def _rows(rows: pa.RecordBatch, at: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    taken = rows.select(["doc_id", "key"]).take(pa.array(at))
    return pa.RecordBatch.from_arrays(
        [*taken.columns, pa.array(values, pa.int64())], ["doc_id", "key", "met"]
    )


def _listed_shingles(words) -> Callable:
    """Rows (doc_id, key, met): distinct shingles of a document that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = words.value
        for batch in batches:
            for rows, texts in byte_chunks(batch, CHUNK):
                sets = [s.view(np.int64) for s in shingle_sets(texts)]
                values = np.concatenate(sets)
                at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                found = contains(listed, values)
                yield _rows(rows, at[found], values[found])

    return run


def contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (doc_id, key, item_id, n_item, n_shared) where a document holds ``percent`` of an item.

    Counted are distinct five-word shingles, A-Z in lower case. An item of one to four words has
    one shingle, its whole text, which only a document of the same words holds; an item without
    words is in no document. ``key`` is xxhash64 of the text. Documents that repeat an id and text
    give one pair, so do items; null ids take part. Empty tables give an empty result. Other
    columns are left behind.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")
    sets = staged(
        items.select("item_id", "text").mapInArrow(
            _item_sets,
            "item_id long, n long, partition int, shingles array<long>, keys array<long>",
        ),
        "items",
    )
    # Exponents of two: a few numbers, however many items there are.
    partitions = sorted(r[0] for r in sets.select("partition").distinct().collect())
    sketched = sets.select("item_id", F.explode("keys").alias("met"))
    filtered = spark.sparkContext.broadcast(bloom(sketched, "met"))
    hits = rows.mapInArrow(_segment_keys(filtered, partitions), "doc_id long, key long, met long")
    candidates = staged(
        hits.distinct().join(sketched, "met").select("doc_id", "key", "item_id").distinct(),
        "candidates",
    )

    listed = sets.select("item_id", "n", F.explode("shingles").alias("met")).distinct()
    filtered = spark.sparkContext.broadcast(bloom(listed, "met"))
    wanted = candidates.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    met = rows.join(
        wanted, same(F.col("doc_id"), F.col("_id")) & (F.col("key") == F.col("_key")), "left_semi"
    )
    shared = met.mapInArrow(_listed_shingles(filtered), "doc_id long, key long, met long").distinct()
    pairs = shared.join(listed, "met").groupBy("doc_id", "key", "item_id", "n")
    counted = pairs.agg(F.count(F.lit(1)).alias("n_shared"))
    counted = counted.filter(100 * F.col("n_shared") >= percent * F.col("n"))
    # Only what the search has found counts.
    found = candidates.select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("item_id").alias("_item")
    )
    proven = counted.join(
        found,
        same(F.col("doc_id"), F.col("_id"))
        & (F.col("key") == F.col("_key"))
        & same(F.col("item_id"), F.col("_item")),
        "left_semi",
    )
    return proven.select("doc_id", "key", "item_id", F.col("n").alias("n_item"), "n_shared")
