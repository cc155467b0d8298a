"""Packing documents into windows in order, by dynamic programming over cut places.

The documents of a block follow each other as one stream of ids. Windows may end at document ends,
at sentence ends and, inside sentences longer than ``STRIDE`` ids, at every ``STRIDE`` ids. Of all
ways to cut, the one of least padding plus penalties is taken. The cheapest start of a window that
ends at a place is the least of a sliding range, which a monotone queue holds, so the work grows
with the number of places. Blocks are cut independently, each of a range of document ids that ends
with the document that brings it to ``BLOCK_TOKENS`` ids, or with its task's last.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import byte_chunks
from tillroll.llm.tokens import byte_level

WINDOW = 2048
STRIDE = 128
SENTENCE_PENALTY, INSIDE_PENALTY = 8, 32
BLOCK_TOKENS = 1 << 20
PARTITION_BYTES, MOST_TASKS = 16 << 20, 8192  # a task takes its blocks one after the other
CHUNK = 1 << 20

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def best_cuts(places: np.ndarray, penalties: np.ndarray, window: int = WINDOW) -> list[int]:
    """The places at which windows end; ``places`` rise, are at most ``window`` apart, end the stream."""
    cost = [0]  # least cost of a stream that ends at the place, plus the place: what a start costs
    came = [0]
    at = [0, *places.tolist()]
    queue = deque([0])
    for j, penalty in enumerate(penalties.tolist(), 1):
        here = at[j]
        while at[queue[0]] < here - window:
            queue.popleft()
        best = queue[0]
        value = cost[best] + window + penalty  # padding is window - (here - at[best])
        cost.append(value)
        came.append(best)
        while queue and cost[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = came[j]
    return cuts[::-1]


def cut_places(
    ids: np.ndarray, lengths: np.ndarray, ends: np.ndarray, opens: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cuts of a stream of documents, and the penalty of each."""
    penalty = np.full(len(ids) + 1, -1, np.int32)
    penalty[np.flatnonzero(ends[ids[:-1]] & opens[ids[1:]]) + 1] = SENTENCE_PENALTY
    penalty[np.cumsum(lengths)] = 0
    known = np.concatenate([[0], np.flatnonzero(penalty >= 0)])
    for i in np.flatnonzero(np.diff(known) > STRIDE):
        penalty[np.arange(known[i] + STRIDE, known[i + 1], STRIDE)] = INSIDE_PENALTY
    places = np.flatnonzero(penalty >= 0)
    return places, penalty[places]


def _pieces(names: list[int | None], texts: list[np.ndarray], marks, first: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of one block, whose windows are numbered from ``first``; the next free number."""
    ids = np.concatenate(texts)
    lengths = np.array([len(t) for t in texts])
    windows = np.array(best_cuts(*cut_places(ids, lengths, *marks)))
    doc_ends = np.cumsum(lengths)
    ends = np.union1d(windows, doc_ends)
    starts = np.concatenate([[0], ends[:-1]])
    doc = np.searchsorted(doc_ends, starts, "right")
    window = np.searchsorted(windows, starts, "right")
    window_starts = np.concatenate([[0], windows[:-1]])
    wide = ids.astype("<u4")
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([names[d] for d in doc], pa.int64()),
            pa.array(starts - (doc_ends - lengths)[doc], pa.int64()),
            pa.array(ends - starts, pa.int64()),
            pa.array([wide[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary()),
            pa.array(lengths[doc], pa.int64()),
            pa.array(first + window, pa.int64()),
            pa.array(starts - window_starts[window], pa.int64()),
        ],
        ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
    )
    return batch, first + len(windows)


def _packed(vocabulary: str, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = byte_level(vocabulary)
        marks = tokenizer.sentence_marks
        number = TaskContext.get().partitionId() << 36
        names, texts, held = [], [], 0
        for batch in batches:
            for rows, data in byte_chunks(batch, CHUNK):
                found = tokenizer.encode(t.decode() for t in data)
                for name, ids in zip(rows.column("doc_id").to_pylist(), found, strict=True):
                    names.append(name)
                    texts.append(np.append(np.frombuffer(ids, tokenizer.dtype), tokenizer.dtype.type(end_id)))
                    held += len(texts[-1])
                    if held >= BLOCK_TOKENS:
                        out, number = _pieces(names, texts, marks, number)
                        yield out
                        names, texts, held = [], [], 0
        if texts:
            yield _pieces(names, texts, marks, number)[0]

    return run


def packed(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Pieces of all documents (doc_id, text), in the order of ids, in windows of ``WINDOW`` ids.

    ``ids`` are a piece's ids as little-endian unsigned 32-bit integers, ``sequence_id`` names its
    window. Every document ends with ``end_id``; a null or empty text is that id alone. Null ids
    come first. Repeated rows are packed one by one. An empty table gives no pieces; other columns
    are left behind.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = rows.repartitionByRange(min(size // PARTITION_BYTES + 1, MOST_TASKS), "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(_packed(vocabulary, end_id), PIECES)
