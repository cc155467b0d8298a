"""Removal of repeated byte strings by merged suffix orders.

Every byte string of ``LENGTH`` bytes that starts earlier, in a document of smaller id or further
up, is removed where it comes again. A suffix array of all bytes is not needed for that: suffixes are
sampled at anchors. An anchor is the start of the ``SEED``-byte string with the least hash among
those of some ``LENGTH``-byte window. Which one it is follows from the window's bytes alone, so two
equal windows have an anchor at the same place, and with it an equal seed.

Anchors whose seed is found once are dropped. The others are brought together by seed with the bytes
on both sides, each task's in the order it found them. They are merged as sorted runs of a
Burrows-Wheeler transform are: the interleave of all runs starts as one interval per seed, and is
refined one symbol per round, only where an interval still holds several suffixes. An interval
of depth d holds the suffixes with a common prefix of d bytes; the symbols before the suffixes are
refined in the same way. A window is repeated if it shares both intervals of its two halves with
an earlier anchor. No suffixes are compared or sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tillroll.llm.bloom import passing
from tillroll.llm.common import byte_chunks, same, staged, unstaged
from tillroll.llm.shingles import BASE, U, mixed, power

LENGTH, SEED = 100, 32
SPREAD = LENGTH - SEED + 1  # seeds in a window, and places of a seed in it
REACH = LENGTH - SEED  # bytes on either side of a seed that its windows cover
CHUNK = 2 << 20
SEGMENT = 4 << 20  # windows looked at together; a place in a segment takes 24 bits
ROWS_AT_ONCE = 30_000

ANCHOR = "seed long, doc_id long, key int, place int"
CONTEXT = "seed long, doc_id long, key int, place int, before binary, after binary, last int"
SPAN = "doc_id long, key int, first int, last int"
CUT = "doc_id long, key int, n_removed long, n_spans long, kept binary"


def anchors(data: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and seeds of the anchors of texts laid end to end; ``owner`` numbers each byte's text.

    The least hash of a window is that of its first place with the least 40 bits.
    """
    places, seeds = [np.zeros(0, np.int64)], [np.zeros(0, U)]
    powers = power(BASE, SEED + 1)
    for start in range(0, max(len(data) - LENGTH + 1, 0), SEGMENT):
        part = data[start : start + SEGMENT + LENGTH - 1]
        hashes, step = part.astype(U) + U(1), 1
        while step < SEED:  # of 2, 4, ... SEED bytes
            hashes = hashes[:-step] * powers[step] + hashes[step:]
            step *= 2
        hashes = mixed(hashes)
        least, step = (hashes >> U(24) << U(24)) | np.arange(len(hashes), dtype=U), 1
        while step * 2 <= SPREAD:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        n = len(part) - LENGTH + 1
        least = np.minimum(least[:n], least[SPREAD - step : SPREAD - step + n])
        whose = owner[start : start + len(part)]
        one_text = whose[:n] == whose[LENGTH - 1 :]
        found = np.unique(least[one_text] & U((1 << 24) - 1)).astype(np.int64)
        places.append(found + start)
        seeds.append(hashes[found])
    place, at = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(seeds)[at].view(np.int64)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in byte_chunks(batch, CHUNK):
            sizes = np.array([len(t) for t in texts])
            data = np.frombuffer(b"".join(texts), np.uint8)
            owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
            place, seed = anchors(data, owner)
            text = owner[place]
            named = rows.select(["doc_id", "key"]).take(pa.array(text))
            within = (place - (np.cumsum(sizes) - sizes)[text]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed), *named.columns, pa.array(within)], ["seed", "doc_id", "key", "place"]
            )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stands before and after the seeds ``at`` of each text, ``before`` from the seed outward.

    Of a batch's anchors with the same bytes on both sides the earliest is kept. All windows of
    the others come again, so their range is known: it goes out as ``place`` and ``last``.
    """
    for batch in batches:
        for rows, texts in byte_chunks(batch, CHUNK):
            ids, keys = rows.column("doc_id").to_pylist(), rows.column("key").to_pylist()
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, keys[i]))
            found, known = [], set()
            for i in order:
                text = texts[i]
                for hit in sorted(rows.column("at")[i].as_py(), key=lambda h: h["place"]):
                    p, seed = hit["place"], hit["seed"]
                    before = text[max(p - REACH, 0) : p]
                    after = text[p + SEED : p + LENGTH]
                    sides = (seed, before, after)
                    if sides not in known:
                        known.add(sides)
                        found.append((seed, ids[i], keys[i], p, before[::-1], after, None))
                    elif len(before) + len(after) >= REACH:
                        spread = hash((ids[i], p))  # any task may pass it on
                        last = p + SEED + len(after)
                        found.append((spread, ids[i], keys[i], p - len(before), None, None, last))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32())
            columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
            names = ["seed", "doc_id", "key", "place", "before", "after", "last"]
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names)


def _symbols(column: pa.Array) -> np.ndarray:
    """A row of REACH symbols per value; 256 where the text has ended."""
    values = column.to_pylist()
    sizes = np.array([len(v) for v in values])
    out = np.full((len(values), REACH), 256, np.int64)
    out[np.arange(REACH) < sizes[:, None]] = np.frombuffer(b"".join(values), np.uint8)
    return out


def refined(interval: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The interval of every suffix at depths 0 to REACH; -1 once it is the only one in its interval.

    Round d splits each interval by the d-th symbol and keeps the order of its parts. Where it is
    split, d is the length of the common prefix of neighbours.
    """
    out = np.full((REACH + 1, len(interval)), -1, np.int64)
    out[0] = interval
    alive = np.arange(len(interval))
    for depth in range(REACH):
        key = out[depth, alive] * 257 + symbols[alive, depth]
        _, part, counts = np.unique(key, return_inverse=True, return_counts=True)
        stay = (counts[part] > 1) & (symbols[alive, depth] < 256)
        alive = alive[stay]
        if not len(alive):
            break
        out[depth + 1, alive] = part[stay]
    return out


def repeated_ranges(seeds: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes, in order of their texts, with a window found earlier, and how far such windows reach.

    Per such suffix the largest and the least number of bytes of a repeated window before its seed.
    """
    _, interval = np.unique(seeds, return_inverse=True)
    left, right = refined(interval, before), refined(interval, after)
    far = np.full(len(seeds), -1)
    near = np.full(len(seeds), LENGTH)
    for o in range(REACH + 1):
        held = np.flatnonzero((left[o] >= 0) & (right[REACH - o] >= 0))
        key = left[o, held] * (len(seeds) + 1) + right[REACH - o, held]
        _, first = np.unique(key, return_index=True)
        again = np.ones(len(held), bool)
        again[first] = False
        rows = held[again]
        far[rows] = o
        near[rows] = np.minimum(near[rows], o)
    rows = np.flatnonzero(far >= 0)
    return rows, far[rows], near[rows]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated ranges of a task's suffixes, which come by seed, then by document and place."""
    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        if len(held) < ROWS_AT_ONCE:
            continue
        seeds = held.column("seed").to_numpy()
        end = int(np.searchsorted(seeds, seeds[-1]))  # the last seed may go on
        if end:
            yield _ranges(held.slice(0, end))
            held = held.slice(end)
    if held is not None and len(held):
        yield _ranges(held)


def _ranges(table: pa.Table) -> pa.RecordBatch:
    known = table.filter(table.column("last").is_valid())
    table = table.filter(table.column("last").is_null())
    before, after = (_symbols(table.column(name)) for name in ("before", "after"))
    rows, far, near = repeated_ranges(table.column("seed").to_numpy(), before, after)
    place = table.column("place").to_numpy()[rows]
    met = table.select(["doc_id", "key"]).take(pa.array(rows))
    met = met.append_column("first", pa.array(place - far, pa.int32()))
    met = met.append_column("last", pa.array(place - near + LENGTH, pa.int32()))
    known = known.select(["doc_id", "key", "place", "last"]).rename_columns(met.column_names)
    both = pa.concat_tables([met, known]).combine_chunks()
    return pa.RecordBatch.from_arrays([c.combine_chunks() for c in both.columns], both.column_names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in byte_chunks(batch, CHUNK):
            removed, spans, kept = [], [], []
            for text, ranges in zip(texts, rows.column("ranges").to_pylist(), strict=True):
                steps = np.zeros(len(text) + 1, np.int32)
                np.add.at(steps, [r["first"] for r in ranges], 1)
                np.add.at(steps, [r["last"] for r in ranges], -1)
                gone = np.cumsum(steps[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]]))))
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("key"),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "key", "n_removed", "n_spans", "kept"],
            )


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [kept.decode(errors="ignore") for kept in batch.column("kept").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(texts, pa.string())], ["doc_id", "key", "text"]
        )


def kept_texts(removed: DataFrame) -> DataFrame:
    """(doc_id, key, text) of changed documents: what is left as text, without the bytes of characters
    that a cut went through. Replacement signs that the source held stay."""
    kind = removed.schema["doc_id"].dataType.simpleString()
    return removed.filter("kept IS NOT NULL").select("doc_id", "key", "kept").mapInArrow(
        _decoded, f"doc_id {kind}, key int, text string"
    )


def _same_document(left: str, right: str):
    return same(F.col(f"{left}.doc_id"), F.col(f"{right}.doc_id")) & (
        F.col(f"{left}.key") == F.col(f"{right}.key")
    )


def _of_documents(rows: DataFrame, grouped: DataFrame) -> DataFrame:
    """``grouped`` (doc_id, key, one more column) with the texts of its documents, one row each."""
    mark = F.xxhash64("doc_id", "key").alias("mark")
    near = passing(rows.select("doc_id", "key", "text", mark), grouped.select(mark), "mark")
    near = near.dropDuplicates(["doc_id", "key"])
    met = near.alias("t").join(grouped.alias("g"), _same_document("t", "g"))
    return met.select("t.doc_id", "t.key", "t.text", f"g.{grouped.columns[-1]}")


def repeats_removed(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, key): n_bytes, n_removed, n_spans and ``kept``, its remaining bytes.

    ``kept`` is null where the text is unchanged; ``key`` is hash(text). A null text is empty.
    Documents are in the order of doc_id, nulls first; of one id, in the order of ``key``. Rows that
    repeat an id and text are one document, with one row. Documents equal to an earlier one are
    removed whole from ``LENGTH`` bytes on and take no further part. Seeds are told apart by 64-bit
    hashes, different texts of one id by ``key``, which has 32 bits. An empty table gives an empty result; other columns are left behind.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.hash(text).alias("key"), text.alias("text"))
    marks = rows.select(
        "doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")
    ).distinct()
    order = F.struct("doc_id", "key")
    firsts = marks.groupBy("sha").agg(F.min(order).alias("first"))
    marks = staged(marks.join(firsts, "sha").withColumn("copy", order != F.col("first")).drop("first"), "marks")
    copies = marks.filter("copy").select("doc_id", "key")

    hits = _several(rows.mapInArrow(_anchor_rows, ANCHOR))
    hits = staged(hits.alias("h").join(copies.alias("c"), _same_document("h", "c"), "left_anti"), "hits")
    # A set, as a repeated row has the same anchors again.
    at = _several(hits).groupBy("doc_id", "key").agg(F.collect_set(F.struct("place", "seed")).alias("at"))
    at = staged(at, "anchors")
    unstaged(hits)
    held = _of_documents(rows, at).mapInArrow(_contexts, CONTEXT)
    runs = held.repartition("seed").sortWithinPartitions("seed", "doc_id", "key", "place")
    ranges = runs.mapInArrow(_merged, SPAN).groupBy("doc_id", "key")
    ranges = staged(ranges.agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "ranges")
    unstaged(at)
    cut = _of_documents(rows, ranges).mapInArrow(_cut, CUT)

    met = marks.alias("m").join(cut.alias("x"), _same_document("m", "x"), "left")
    whole = F.col("copy") & (F.col("n_bytes") >= LENGTH)
    zero = F.lit(0).cast("long")
    return met.select(
        "m.doc_id",
        "m.key",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", zero)).cast("long").alias("n_spans"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        "sha",
    )


def _several(anchor_rows: DataFrame) -> DataFrame:
    """The anchors whose seed is found several times; one shuffle."""
    counted = anchor_rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("seed")))
    return counted.filter("n > 1").drop("n")
