"""Ranked lexical search: all documents scored for each item, by blocked dense multiplication.

Items are taken in blocks of bounded size. The terms of a block are its vocabulary; the weights of an
item's terms are a row of a dense matrix, the impacts of a document's terms a column of another. Tiles
of both are multiplied in doubles. Weights and impacts are whole numbers, and a tile's columns and
weights are bounded so that no partial sum reaches 2^53; tiles are added up as 64-bit integers, so
scores are exact. Each task keeps the best documents of each item, ties settled by id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillroll.llm.common import byte_chunks, noted
from tillroll.storage import new_folder

BEST = 20

# A block of items: at most so many items, and so many different terms unless one item has more.
BLOCK_ITEMS, BLOCK_TERMS = 256, 1 << 15
# A tile: so many terms by so many documents, and texts of so many bytes (or one).
TILE_TERMS, TILE_DOCS, CHUNK = 4096, 512, 4 << 20
# Documents of an item that meet in one task before the last: a fixed number of groups.
GROUPS = 64

EXACT = 2**53 - 1
IMPACT = 1_000_000  # impacts are smaller
DIGIT = 20  # a weight beyond 2^20 is cut into digits of so many bits

# What separates terms, as bytes; all other bytes are part of terms.
SEPARATORS = bytes(b for b in range(0x80) if not chr(b).isalnum())
PLAIN = bytes.maketrans(
    SEPARATORS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(SEPARATORS) + b"abcdefghijklmnopqrstuvwxyz"
)

STATISTIC = "term int, n long"
DOCUMENTS, TERMS = -1, -2  # stand in for a term: documents with terms, and all their terms


def terms(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


@dataclass
class Block:
    """Items with their terms, numbered as columns in order of appearance."""

    ids: list = field(default_factory=list)
    counts: list[dict[int, int]] = field(default_factory=list)
    column: dict[bytes, int] = field(default_factory=dict)

    def add(self, item_id: object, counted: Mapping[bytes, int]) -> None:
        self.ids.append(item_id)
        self.counts.append({self.column.setdefault(term, len(self.column)): n for term, n in counted.items()})

    def full(self, counted: Mapping[bytes, int]) -> bool:
        more = sum(term not in self.column for term in counted)
        return bool(self.ids) and (len(self.ids) == BLOCK_ITEMS or len(self.column) + more > BLOCK_TERMS)


def blocks(items: Iterable[tuple[object, str | None]]) -> Iterator[Block]:
    """Items in blocks, one held at a time; items without terms are in none."""
    block = Block()
    for item_id, text in items:
        counted = Counter(terms((text or "").encode()))
        if not counted:
            continue
        if block.full(counted):
            yield block
            block = Block()
        block.add(item_id, counted)
    if block.ids:
        yield block


def _statistics(batches: Iterator[pa.RecordBatch], column: Mapping[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Documents with terms, all their terms, and the documents that hold each of the columns' terms."""
    documents = all_terms = 0
    holding = np.zeros(len(column), np.int64)
    for batch in batches:
        for _, texts in byte_chunks(batch, CHUNK):
            for text in texts:
                found = terms(text)
                documents += bool(found)
                all_terms += len(found)
                holding[[column[term] for term in set(found) & column.keys()]] += 1
    (held,) = np.nonzero(holding)
    numbers = np.concatenate([[DOCUMENTS, TERMS], held])
    counts = np.concatenate([[documents, all_terms], holding[held]])
    yield pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(counts, pa.int64())], names=["term", "n"]
    )


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def tiles(weights: np.ndarray, width: int = TILE_TERMS) -> Iterator[tuple[slice, list[tuple[int, np.ndarray]]]]:
    """The columns in tiles, each as (shift, digits) whose products with impacts stay exact.

    A digit is below 2^20 and a tile at most 4096 = 2^12 columns wide: 2^32 times 10^6 is below 2^53.
    """
    width = min(width, EXACT // (IMPACT << DIGIT))
    for start in range(0, weights.shape[1], width):
        left = weights[:, start : start + width]
        digits, shift = [], 0
        while left.any():
            digits.append((shift, (left & ((1 << DIGIT) - 1)).astype(np.float64)))
            left, shift = left >> DIGIT, shift + DIGIT
        yield slice(start, start + width), digits


class Best:
    """The best documents so far of each item: highest score, then smallest id, rows without one last."""

    def __init__(self, items: int, most: int):
        self.most = most
        self.least = np.ones(items, np.int64)  # a score below it is not among the best
        self.item, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))
        self.no_id = np.empty(0, bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        """Scores by item and document; one equal to the least stays in until ids decide."""
        item, at = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        item, score = np.append(self.item, item), np.append(self.score, scores[item, at])
        doc, no_id = np.append(self.doc, doc[at]), np.append(self.no_id, no_id[at])
        order = np.lexsort((doc, no_id, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order, place = order[place < self.most], place[place < self.most]
        self.item, self.score, self.doc, self.no_id = item[order], score[order], doc[order], no_id[order]
        last = place == self.most - 1
        self.least[self.item[last]] = self.score[last]


def impacts(tf: np.ndarray, n_terms: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    m = 100 - 25 + (25 * n_terms * documents) // all_terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _scored(
    batches: Iterator[pa.RecordBatch],
    column: Mapping[bytes, int],
    weights: np.ndarray,
    documents: int,
    all_terms: int,
    most: int,
) -> Iterator[pa.RecordBatch]:
    best = Best(len(weights), most)
    cut = list(tiles(weights))
    for batch in batches:
        for rows, texts in byte_chunks(batch, CHUNK):
            for first in range(0, len(texts), TILE_DOCS):
                held = texts[first : first + TILE_DOCS]
                at, col, tf, sizes = [], [], [], []
                for k, text in enumerate(held):
                    found = terms(text)
                    counted = Counter(map(column.get, found))
                    counted.pop(None, None)
                    if counted:
                        at.append(np.full(len(counted), k))
                        col.append(np.fromiter(counted.keys(), np.int64, len(counted)))
                        tf.append(np.fromiter(counted.values(), np.int64, len(counted)))
                        sizes.append(np.full(len(counted), len(found)))
                if not at:
                    continue
                at, col, tf, sizes = map(np.concatenate, (at, col, tf, sizes))
                impact = impacts(tf, sizes, documents, all_terms)
                scores = np.zeros((len(weights), len(held)), np.int64)
                for span, digits in cut:
                    inside = (col >= span.start) & (col < span.stop)
                    used, row = np.unique(col[inside], return_inverse=True)
                    if not len(used):
                        continue
                    tile = np.zeros((len(used), len(held)))
                    tile[row, at[inside]] = impact[inside]
                    for shift, digit in digits:
                        scores += (digit[:, used - span.start] @ tile).astype(np.int64) << shift
                ids = rows.column("doc_id").slice(first, len(held))
                best.add(scores, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(best.item, pa.int32()),
            pa.array(best.doc, pa.int64(), mask=best.no_id),
            pa.array(best.score, pa.int64()),
        ],
        names=["item", "doc_id", "score"],
    )


def _ranked(rows: DataFrame, most: int) -> DataFrame:
    """The best of all tasks. An item's rows, some per task, are first cut in groups by document."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    group = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(GROUPS))
    once = Window.partitionBy("item", "_group").orderBy(*order)
    rows = rows.withColumn("_group", group).withColumn("rank", F.row_number().over(once))
    rows = rows.filter(F.col("rank") <= most).drop("rank", "_group")
    ranks = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranks.filter(F.col("rank") <= most)


def block_ranks(docs: DataFrame, block: Block, most: int) -> DataFrame:
    """(item, rank, doc_id, score) of one block, ``item`` being its number there; two passes over the texts."""
    column = block.column
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = texts.select("text").mapInArrow(lambda batches: _statistics(batches, column), STATISTIC)
    # One row per term of the block, which is bounded.
    found = {row["term"]: row["n"] for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    documents, all_terms = found.get(DOCUMENTS, 0), found.get(TERMS, 0)
    weights = np.zeros((len(block.ids), len(column)), np.int64)
    for item, counts in enumerate(block.counts):
        for term, n in counts.items():
            if term in found:
                weights[item, term] = n * term_weight(documents, found[term])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scored(batches, column, weights, documents, all_terms, most)

    return _ranked(texts.mapInArrow(scored, "item int, doc_id long, score long"), most)


def best_documents(docs: DataFrame, items: DataFrame, most: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the highest-scoring documents of each item, above 0.

    ``doc_id`` is a whole number. Equal scores go by ascending id, a document without an id last.
    Null and empty texts have no terms: such documents count nowhere, such items get no rows. Equal rows
    of items are one item, equal rows of documents are ranked each. Empty tables give an empty result.
    Other columns are not read. Items come to the driver block by block; a block and one document at
    a time are held in memory.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    rows = items.select("item_id", "text").distinct()
    path = new_folder(spark, "ranks")
    schema = f"item_id {kind.simpleString()}, rank int, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    noted(spark, path)
    for block in blocks((row["item_id"], row["text"]) for row in rows.toLocalIterator()):
        ids: Sequence = list(enumerate(block.ids))
        names = spark.createDataFrame(ids, f"item int, item_id {kind.simpleString()}")
        ranks = block_ranks(docs, block, most).join(F.broadcast(names), "item")
        ranks.select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
