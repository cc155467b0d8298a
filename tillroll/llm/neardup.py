"""Near-duplicates by MinHash with tensored banding; links are confirmed on whole shingle sets.

Two small collections of MinHash groups, A and B, are computed per document. Every pair of a group
of A and one of B is a table key, so ``groups`` squared tables of ``2 * rows`` hashes each need
only ``2 * groups * rows`` hashes in all. Documents meet in a table if they agree on both halves.
At similarity 0.75 a pair misses all tables with a probability below 0.0004, at 0.8 below 0.00003.

Equal shingle sets are one class from the start, so copies are never compared, and of buckets with
the same classes one is kept. First every class is compared with one other, the class with most
company in all its buckets, such as the text that a group of near copies was made from. That settles
most buckets. What is left in buckets that still hold several components is compared block by
block: classes of the same first class are dealt into blocks of bounded size, and blocks that meet
in a bucket are multiplied as matrices of sets by shingles. A join row is a pair of blocks, never a
pair of classes, so a large group whose pairs lie just below the limit makes few rows, and
no link between classes that share a bucket is lost. Two classes are compared only if the link is
possible at all: the shingles that two sets share are found in several sets of unfinished buckets,
so a set with few such shingles cannot share enough with any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tillroll.llm.bloom import bloom, contains
from tillroll.llm.common import byte_chunks, freed, same, staged, unstaged
from tillroll.llm.components import components
from tillroll.llm.shingles import CHUNK, U, mixed, seeds, shingle_hashes, shingle_sets

GROUPS, ROWS = 16, 3
PERCENT = 75
BLOCK_SETS, BLOCK_BYTES = 256, 256 << 10  # of a block: about so many sets, or so large
COLUMNS = 8192  # shingles that are multiplied at once

_FLIPS, _TIMES = seeds(2 * GROUPS * ROWS, 3)
_MARKS = seeds(2, 5)

SIGNATURE = "doc_id long, key long, n long, node binary, a array<long>, b array<long>"


def _digest(shingles: np.ndarray) -> bytes | None:
    """128 bits that name a shingle set; null for the empty set."""
    if not len(shingles):
        return None
    sums = [int(mixed((shingles ^ c) * m).sum()) for c, m in zip(*_MARKS, strict=True)]
    return b"".join(x.to_bytes(8, "big") for x in sums)


def _groups(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the groups of A and of B, a row for each text that has shingles."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    values = np.zeros((2 * GROUPS, len(starts)), U)
    for k, (flip, times) in enumerate(zip(_FLIPS, _TIMES, strict=True)):
        least = np.minimum.reduceat((hashes ^ flip) * times, starts)
        values[k // ROWS] = mixed(values[k // ROWS] + least)
    rows = values.T.astype(np.int64)
    return rows[:, :GROUPS], rows[:, GROUPS:]


def _lists(rows: np.ndarray, present: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(present * GROUPS)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel()))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in byte_chunks(batch, CHUNK):
            hashes, sizes = shingle_hashes(texts)
            ends = np.cumsum(sizes)
            sets = [np.unique(hashes[e - s : e]) for e, s in zip(ends, sizes, strict=True)]
            present = sizes > 0
            a = b = np.zeros((0, GROUPS), np.int64)
            if present.any():
                a, b = _groups(hashes, sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    _lists(a, present),
                    _lists(b, present),
                ],
                ["doc_id", "key", "n", "node", "a", "b"],
            )


def _sets(words) -> Callable:
    """Rows (node, shingles) of the texts whose key the filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = words.value
        for batch in batches:
            found = contains(wanted, batch.column("key").to_numpy())
            for _, texts in byte_chunks(batch.filter(pa.array(found)), CHUNK):
                sets = shingle_sets(texts)
                columns = [
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "shingles"])

    return run


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, met) of every shingle of the sets."""
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("shingles")]
        at = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        columns = [batch.column("node").take(pa.array(at)), pa.array(np.concatenate(sets))]
        yield pa.RecordBatch.from_arrays(columns, ["node", "met"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose sets xs and ys are similar."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("xs"), batch.column("ys"), strict=True):
            small, large = sorted((np.frombuffer(v.as_buffer(), U) for v in (x, y)), key=len)
            if 100 * len(small) < PERCENT * len(large):
                keep.append(False)
                continue
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            shared = int((large[at] == small).sum())
            keep.append(100 * shared >= PERCENT * (len(small) + len(large) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _shared(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of ``xs`` shares with each of ``ys``."""
    values, place = np.unique(np.concatenate([*xs, *ys]), return_inverse=True)
    cut = sum(map(len, xs))
    both = np.isin(np.arange(len(values)), place[:cut]) & np.isin(np.arange(len(values)), place[cut:])
    column = np.where(both, np.cumsum(both) - 1, -1)[place]
    out = np.zeros((len(xs), len(ys)), np.float32)
    sides = []
    for sets, columns in ((xs, column[:cut]), (ys, column[cut:])):
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        sides.append((len(sets), row[columns >= 0], columns[columns >= 0]))
    for low in range(0, int(both.sum()), COLUMNS):
        parts = []
        for n, row, columns in sides:
            here = (columns >= low) & (columns < low + COLUMNS)
            part = np.zeros((n, COLUMNS), np.float32)
            part[row[here], columns[here] - low] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out.astype(np.int64)


def _joining(roots: tuple[list, list], linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Of the linked pairs of two blocks, as many as join their components; the others follow."""
    parent: dict = {}

    def top(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = top(roots[0][i]), top(roots[1][j])
        if a != b:
            parent[a] = b
            yield int(i), int(j)


def _blocks_linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) between the classes of two blocks, xs and ys, that join components."""
    for batch in batches:
        found: list[tuple[bytes, bytes]] = []
        for x, y in zip(batch.column("xs"), batch.column("ys"), strict=True):
            x, y = x.as_py(), y.as_py()
            sets = [[np.frombuffer(c["shingles"], U) for c in side] for side in (x, y)]
            roots = [c["root"] for c in x], [c["root"] for c in y]
            sizes = [np.array([len(c) for c in side]) for side in sets]
            shared = _shared(*sets)
            union = sizes[0][:, None] + sizes[1] - shared
            pairs = _joining(roots, 100 * shared >= PERCENT * union)
            found += [(x[i]["node"], y[j]["node"]) for i, j in pairs]
        columns = [pa.array([pair[k] for pair in found], pa.binary()) for k in range(2)]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, node) of all table buckets that hold several classes.

    A pair of groups is only formed where each of its halves already has company.
    """
    halves = []
    for name in ("a", "b"):
        rows = classes.select("node", F.posexplode(name).alias(f"{name}_at", f"{name}_value"))
        at = [f"{name}_at", f"{name}_value"]
        met = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("_met")).filter("_met > 1").drop("_met")
        halves.append(rows.join(met, at, "left_semi"))
    pairs = halves[0].join(halves[1], "node")
    keyed = pairs.select(F.xxhash64("a_at", "a_value", "b_at", "b_value").alias("key"), "node")
    alike = ["size", "mark", "mark2"]
    met = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"),
        F.expr("bit_xor(xxhash64(node))").alias("mark"),
        F.expr("bit_xor(xxhash64(node, 1))").alias("mark2"),
    )
    met = met.filter("size > 1").groupBy(*alike)
    met = met.agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("times"))
    rows = keyed.join(met.select("key", (F.col("size") * F.col("times")).alias("company")), "key")
    rows = staged(rows, "members")
    company = rows.groupBy("node").agg(F.sum("company").alias("all"))
    place = F.struct((-F.col("all")).alias("rank"), F.col("node").alias("node"))
    buckets = staged(rows.join(company, "node").select("key", "node", place.alias("place")), "buckets")
    unstaged(rows)
    return buckets


def _links(classes: DataFrame, set_rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Confirmed links (a, b) between classes: all that join components."""
    spark = classes.sparkSession
    buckets = _buckets(classes)
    members = buckets.select("node").distinct()
    sets = staged(set_rows(members), "sets")
    freed(spark)

    def confirmed(pairs: DataFrame) -> DataFrame:
        xs = sets.select(F.col("node").alias("b"), F.col("shingles").alias("ys"))
        ys = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xs"))
        both = pairs.join(xs, "b").join(ys, "a").select("a", "b", "xs", "ys")
        return both.mapInArrow(_confirmed, "a binary, b binary")

    # First every class meets one other: the first class of all its buckets.
    first = buckets.groupBy("key").agg(F.min("place").alias("first"))
    pairs = buckets.join(first, "key").filter("first < place")
    pairs = pairs.groupBy(F.col("node").alias("b")).agg(F.min("first").alias("first"))
    compared = staged(pairs.select(F.col("first.node").alias("a"), "b"), "pairs")
    links = staged(confirmed(compared), "links")
    unstaged(compared)
    rows = staged(_unfinished(buckets, components(links)), "open")
    freed(spark)
    if rows.isEmpty():
        return links
    # How many shingles of a set are in another set, too: the most it can share.
    nodes = rows.select("node").distinct()
    shown = sets.join(nodes, "node", "left_semi").mapInArrow(_shingles, "node binary, met long")
    several = shown.groupBy("met").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("met")
    most = shown.join(several, "met", "left_semi").groupBy("node")
    most = most.agg(F.count(F.lit(1)).alias("most"))
    sizes = sets.select("node", (F.octet_length("shingles") / 8).cast("long").alias("n"))
    limits = most.join(sizes, "node").filter(100 * F.col("most") >= PERCENT * F.col("n"))
    buckets = rows.select("key", "node", "place").join(limits, "node")
    roots = components(links)
    rows = staged(_unfinished(buckets, roots), "limited")
    freed(spark)
    return links.unionAll(_block_links(rows, sets))


def _block_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between all classes that share a bucket of ``rows`` (key, node, place, n, root)."""
    first = rows.groupBy("key").agg(F.min("place").alias("first"))
    nodes = rows.join(first, "key").groupBy("node", "n", "root").agg(F.min("first").alias("head"))
    fill = F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") * 8 / BLOCK_BYTES)
    heads = nodes.groupBy("head").agg(F.ceil(fill).alias("parts"))
    part = F.pmod(F.xxhash64("node"), "parts")
    nodes = nodes.join(heads, "head").select(
        "node", "root", F.xxhash64("head.node", part).alias("block")
    )
    nodes = staged(nodes, "dealt")
    roots = nodes.groupBy("block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    met = rows.select("key", "node").join(nodes, "node").select("key", "block").distinct()
    met = met.join(roots, "block")
    left, right = met.alias("l"), met.alias("r")
    apart = F.least("l.low", "r.low") < F.greatest("l.high", "r.high")
    pairs = left.join(right, (F.col("l.key") == F.col("r.key")) & F.expr("l.block <= r.block") & apart)
    pairs = pairs.select(F.col("l.block").alias("x"), F.col("r.block").alias("y")).distinct()
    pairs = staged(pairs, "pairs")
    blocks = nodes.join(sets, "node").groupBy("block")
    blocks = blocks.agg(F.collect_list(F.struct("node", "root", "shingles")).alias("sets"))
    blocks = staged(blocks, "blocks")
    both = pairs.join(blocks.select(F.col("block").alias("x"), F.col("sets").alias("xs")), "x")
    both = both.join(blocks.select(F.col("block").alias("y"), F.col("sets").alias("ys")), "y")
    both = both.select("xs", "ys")
    return staged(both.mapInArrow(_blocks_linked, "a binary, b binary"), "links")


def _unfinished(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components, with ``root``."""
    rows = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    keys = rows.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high")
    )
    return rows.join(keys.filter("low < high").select("key"), "key")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, key, n_shingles, component_id and kept.

    ``key`` is xxhash64 of the text, to find the row again. ``component_id`` is the smallest doc_id
    that links reach. Rows without words have the empty set and are linked with nothing. Null ids
    take part, but only name a component that has no other id. Rows that repeat an id and text get
    the same verdict. An empty table gives an empty result; other columns are left behind.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("key"), text.alias("text"))
    marks = staged(rows.mapInArrow(_signatures, SIGNATURE), "signatures")
    named = marks.filter("node IS NOT NULL")
    classes = staged(
        named.groupBy("node").agg(
            F.min("doc_id").alias("id"), F.first("a").alias("a"), F.first("b").alias("b")
        ),
        "classes",
    )

    def set_rows(members: DataFrame) -> DataFrame:
        """The shingle set of every member class."""
        keys = named.join(members, "node", "left_semi").select("key")
        wanted = docs.sparkSession.sparkContext.broadcast(bloom(keys, "key"))
        found = rows.select("key", "text").mapInArrow(_sets(wanted), "node binary, shingles binary")
        return found.join(members, "node", "left_semi").dropDuplicates(["node"])

    roots = components(_links(classes, set_rows))
    rooted = classes.select("node", "id").join(roots, "node", "left")
    rooted = rooted.select("node", "id", F.coalesce("root", "node").alias("root"))
    named_roots = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    by_class = rooted.select("node", "root").join(named_roots, "root").select("node", "component_id")
    component = F.coalesce("component_id", "doc_id")
    return marks.join(by_class, "node", "left").select(
        "doc_id",
        "key",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        same(F.col("doc_id"), component).alias("kept"),
    )
