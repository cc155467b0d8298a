"""Language-model scores: context-tree weighting over bytes, and word unigrams as a base.

A byte is eight binary decisions, one per node on its way through a binary tree. Each node has a
context tree: for every context of 0 to ``DEPTH`` preceding bytes it has counts of zeros and ones
and their Krichevsky-Trofimov probability. The weighted probability of a context is half its own
plus half the product of its extensions'; what a node predicts is the mixture of its estimates at
all depths with the weights that the training counts leave them.

Texts are read in lower case (A-Z), after ``DEPTH`` zero bytes and with a zero byte at the end, which
is predicted too. All learned tables are distributed. A block of documents lists its distinct strings
of ``DEPTH`` bytes and the next and its distinct words, with their training counts, as sorted and compressed arrays, one or
more for each part; the ``TOP`` bytes before the predicted one decide a string's part. A part adds up
the lists of all blocks, one after the other, and later answers each of them with the words' counts and
the strings' probabilities, so neither is a table row anywhere. Words are told apart by 64-bit hashes. Trees are tables level by level up to ``TOP``
bytes of context; what lies deeper is built from the strings that share those bytes, group by group,
and is never written.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import byte_chunks, freed, staged, unstaged
from tillroll.llm.shingles import mixed, word_hashes

DEPTH = 6
TOP = 3  # contexts up to this depth are rows, deeper ones are arrays of one group
GROUP_ROWS = 1 << 16  # strings whose deep levels are built together, and the rest of the last group
BLOCK_BYTES = 48 << 20
PART_BYTES = 32 << 20
MOST_PARTS, MOST_TASKS = 4096, 8192  # a task takes several parts or blocks, one at a time
LIST_ROWS = 1 << 18  # strings in one list
HELD_ROWS = 1 << 22  # strings that wait to be added up
CHUNK = 1 << 20
FOLDS, HELD_OUT = 5, 1

LISTS = "size int, strings binary, counts binary"
ASKED = f"block int, kind int, part int, {LISTS}"
SUMMED = f"part int, {LISTS}"
WANTED = "part int, context long, node int"
GROWN = "context long, node int, zeros double, ones double, children double"
ANSWER = "block int, kind int, size int, strings binary, values binary"
STRINGS, WORDS = 0, 1  # kinds of lists
TOPS, SUMS, BLOCKS = 0, 1, 2  # what a part reads, in this order
END = 0  # the number of the token that ends a text
SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
    "bits_per_byte double"
)
U = np.uint64
_NEAR, _FAR = 8 * (TOP + 1), 8 * (DEPTH - TOP)  # bits of a string's last TOP + 1 bytes, and of the others


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All strings of ``DEPTH`` bytes and the next, as numbers, and how many each text has.

    The last TOP + 1 bytes come first in a number, so numbers in order keep contexts together.
    """
    front = b"\0" * DEPTH
    data = np.frombuffer(b"".join(front + t + b"\0" for t in texts), np.uint8)
    grams = np.zeros(max(len(data) - DEPTH, 0), U)
    for k in (*range(DEPTH - TOP, DEPTH + 1), *range(DEPTH - TOP)):
        grams = (grams << U(8)) | data[k : len(data) - DEPTH + k]
    counts = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(counts + DEPTH) - counts - DEPTH
    at = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return grams[np.repeat(starts, counts) + at].view(np.int64), counts


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words of texts, each text's with its end, as numbers, and how many each text has."""
    words, counts = word_hashes(texts)
    return np.insert(words.view(np.int64), np.cumsum(counts), END), counts + 1


def _plain(grams: np.ndarray) -> np.ndarray:
    """The same strings with their bytes in the order of the text."""
    return (grams & ((1 << _FAR) - 1)) << _NEAR | grams >> _FAR


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers of eight bytes, first the first bytes of all, compressed."""
    return pa.compress(numbers.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, size: int, kind: type = np.int64) -> np.ndarray:
    data = pa.decompress(packed, 8 * size, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, size).T).view(kind).ravel()


def _listed(grams: np.ndarray) -> bytes:
    """Numbers in ascending order as differences."""
    return _packed(np.diff(grams, prepend=0))


def _grams_of(packed: bytes, size: int) -> np.ndarray:
    return np.cumsum(_unpacked(packed, size))


def _batch(schema: str, **columns) -> pa.RecordBatch:
    """A batch with the columns of a schema; those not given are null."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    size = len(next(iter(columns.values())))
    fields = [field.split() for field in schema.split(", ")]
    arrays = [
        pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(size, kinds[kind])
        for name, kind in fields
    ]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _asked(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Lists of the distinct words and strings that each block holds, with their training counts.

    The documents of a block follow each other, so one block is held at a time.
    """
    now, held = None, {STRINGS: [], WORDS: []}
    for batch in batches:
        for rows, texts in byte_chunks(batch, CHUNK):
            blocks = rows.column("block").to_numpy()
            trained = ~np.array(rows.column("held_out").to_pylist(), bool)
            for block in np.unique(blocks):
                if block != now and now is not None:
                    yield from _block(now, held, parts)
                    held = {STRINGS: [], WORDS: []}
                now = block
                for train in (True, False):
                    at = np.flatnonzero((blocks == block) & (trained == train))
                    own = [texts[i].lower() for i in at]
                    if not own:
                        continue
                    for kind, numbers in ((STRINGS, _grams(own)[0]), (WORDS, _tokens(own)[0])):
                        values, n = np.unique(numbers, return_counts=True)
                        _add(held[kind], values, n if train else np.zeros_like(n))
    if now is not None:
        yield from _block(now, held, parts)


def _add(held: list, values: np.ndarray, n: np.ndarray) -> None:
    """One more list; those that wait are added to the first when they are as long as that one."""
    held.append((values, n))
    if sum(len(v) for v, _ in held[1:]) > max(HELD_ROWS, len(held[0][0])):
        held[:] = [_summed(held)]


def _block(block: int, held: dict[int, list], parts: int) -> Iterator[pa.RecordBatch]:
    for kind, lists in held.items():
        values, n = _summed(lists)
        lists.clear()
        part = (mixed((values >> _FAR + 8).astype(U)) % U(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        values, n = values[order], n[order]
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        for k in range(parts):
            for start in range(edges[k], edges[k + 1], LIST_ROWS):
                at = slice(start, min(start + LIST_ROWS, edges[k + 1]))
                yield _lists(ASKED, values[at], n[at], block=[block], kind=[kind], part=[k])


def _lists(schema: str, grams: np.ndarray, n: np.ndarray, **others) -> pa.RecordBatch:
    return _batch(schema, size=[len(n)], strings=[_listed(grams)], counts=[_packed(n)], **others)


def _summed(held: list) -> tuple[np.ndarray, np.ndarray]:
    """Strings in order with their summed counts, of lists that are each in order."""
    values = np.concatenate([v for v, _ in held])
    order = np.argsort(values, kind="stable")
    values, n = values[order], np.concatenate([n for _, n in held])[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[first], np.add.reduceat(n, first)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of each part with their counts over all blocks, in lists that cut no context apart.

    Lists come by part; besides a part's strings only the lists not yet added to them are held.
    """
    now, held = None, []
    for batch in batches:
        for part, size, strings, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part != now and now is not None:
                yield from _cut(now, *_summed(held))
                held = []
            now = part
            _add(held, _grams_of(strings, size), _unpacked(counts, size))
    if now is not None:
        yield from _cut(now, *_summed(held))


def _cut(part: int, grams: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    context = grams >> _FAR + 8
    edges = np.flatnonzero(np.append(context[1:] != context[:-1], True)) + 1
    start = 0
    while start < len(grams):
        at = np.searchsorted(edges, min(start + GROUP_ROWS, len(grams)))
        yield _lists(SUMMED, grams[start : edges[at]], n[start : edges[at]], part=[part])
        start = edges[at]


def _log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for x >= 0.5, by Stirling's series from 8 further on."""
    low = F.lit(0.0)
    for k in range(8):
        low = low + F.log(x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - low


def _estimate(zeros: Column, ones: Column) -> Column:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return (
        _log_gamma(zeros + 0.5)
        + _log_gamma(ones + 0.5)
        - _log_gamma(zeros + ones + 1.0)
        - math.log(math.pi)
    )


def _steps(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of plain strings: keys (context bytes, then the node's) and bits of the eight decisions of each string."""
    k, byte = np.arange(8), grams[:, None] & 255
    return (grams[:, None] & ~255) | ((256 + byte) >> (8 - k)), (byte >> (7 - k)) & 1


def _short(keys: np.ndarray, depth: int) -> np.ndarray:
    return keys & ((1 << 8 * (depth + 1)) - 1)


def _estimates(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """``_estimate`` of arrays."""

    def log_gamma(x):
        low = x.copy()
        for k in range(1, 8):
            low *= x + k
        y = x + 8
        series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
        return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(low)

    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)


def _deep(grams: np.ndarray, n: np.ndarray) -> tuple[list, tuple]:
    """Levels TOP + 1 to DEPTH (keys, place of the parent, zeros, ones, stop) and the sums at TOP."""
    keys, bits = _steps(grams)
    keys, which = np.unique(keys.ravel(), return_inverse=True)
    n = np.repeat(n, 8)
    ones = np.bincount(which, n * bits.ravel(), len(keys))
    zeros = np.bincount(which, n, len(keys)) - ones
    weighted, stop, levels = _estimates(zeros, ones), np.ones(len(keys)), []
    for depth in range(DEPTH - 1, TOP - 1, -1):
        above, up = np.unique(_short(keys, depth), return_inverse=True)
        levels.insert(0, (keys, up, zeros, ones, stop))
        keys = above
        zeros, ones, children = (np.bincount(up, x, len(keys)) for x in (zeros, ones, weighted))
        own = _estimates(zeros, ones)
        weighted = np.logaddexp(own, children) - math.log(2)
        stop = np.exp(own - math.log(2) - weighted)
    return levels, (keys, zeros, ones, children)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Part, strings and counts of each summed list."""
    for batch in batches:
        for part, size, strings, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield part, _grams_of(strings, size), _unpacked(counts, size)


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per context of TOP bytes and node the counts and what its extensions' probabilities multiply to."""
    for _, grams, n in _held(batches):
        keys, zeros, ones, children = _deep(_plain(grams[n > 0]), n[n > 0])[1]
        yield _batch(GROWN, context=keys >> 8, node=keys & 255, zeros=zeros, ones=ones, children=children)


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes that strings pass, with their contexts of TOP bytes; each once."""
    for part, grams, _ in _held(batches):
        keys = np.unique(_steps(np.unique(grams >> _FAR))[0])
        yield _batch(WANTED, part=np.full(len(keys), part), context=keys >> 8, node=keys & 255)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, n in _held(batches):
        yield _batch("total long, known long", total=[int(n.sum())], known=[int((n > 0).sum())])


def _counts(words: np.ndarray, n: np.ndarray, _tops: None) -> np.ndarray:
    return n.astype(np.float64)


def _answered(batches: Iterator[pa.RecordBatch], kind: int, values_of: Callable) -> Iterator[pa.RecordBatch]:
    """The lists of all blocks with the values of their strings or words.

    Rows come by part; within one first the mixtures of its contexts at TOP, then its summed lists,
    then those of the blocks, which are answered one by one.
    """
    now, tops, found, ready = None, [], [], None
    for batch in batches:
        part, what = (batch.column(c).to_numpy() for c in ("part", "what"))
        starts = np.flatnonzero((np.diff(part, prepend=-1) != 0) | (np.diff(what, prepend=-1) != 0))
        for start, end in zip(starts, [*starts[1:], len(part)], strict=True):
            rows = batch.slice(start, end - start)
            if part[start] != now:
                now, tops, found, ready = part[start], [], [], None
            if what[start] == TOPS:
                tops.append([rows.column(c).to_numpy() for c in ("context", "node", "given", "left")])
                continue
            if isinstance(tops, list):
                tops = _in_order(tops) if tops else None
            names = ("block", "size", "strings", "counts")
            for block, size, strings, counts in zip(*(rows.column(c).to_pylist() for c in names), strict=True):
                numbers = _grams_of(strings, size)
                if what[start] == SUMS:
                    found.append((numbers, values_of(numbers, _unpacked(counts, size), tops)))
                    continue
                if ready is None:
                    ready, found = _sorted(found), []
                values = _packed(ready[1][np.searchsorted(ready[0], numbers)])
                yield _batch(ANSWER, block=[block], kind=[kind], size=[size], strings=[strings], values=[values])


def _sorted(lists: list) -> tuple[np.ndarray, np.ndarray]:
    numbers, values = (np.concatenate(x) for x in zip(*lists, strict=True))
    order = np.argsort(numbers, kind="stable")
    return numbers[order], values[order]


def _in_order(tops: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    context, node, given, left = (np.concatenate(x) for x in zip(*tops, strict=True))
    keys = context << 8 | node
    order = np.argsort(keys)
    return keys[order], given[order], left[order]


def _values(grams: np.ndarray, n: np.ndarray, tops: tuple) -> np.ndarray:
    """log10 of the probability of each string's last byte after the others; whole contexts only.

    ``tops`` are keys of contexts at TOP, with their mixtures so far and the weights left.
    """
    known, given, left = tops
    grams = _plain(grams)
    keys, bits = _steps(grams)
    one = (given + left * 0.5)[np.searchsorted(known, _short(keys, TOP))]
    levels, (at_top, *_) = _deep(grams[n > 0], n[n > 0])
    at = np.searchsorted(known, at_top)
    given, left = given[at], left[at]
    for depth, (held, up, zeros, ones, stop) in enumerate(levels, TOP + 1):
        given, left = given[up], left[up]
        given = given + left * stop * (ones + 0.5) / (zeros + ones + 1)
        left = left * (1 - stop)
        if len(held):
            asked = _short(keys, depth)
            at = np.minimum(np.searchsorted(held, asked), len(held) - 1)
            one = np.where(held[at] == asked, (given + left * 0.5)[at], one)
    return np.log10(np.where(bits == 1, one, 1 - one)).sum(axis=1)


def _trees(summed: DataFrame) -> list[DataFrame]:
    """Per depth 0 to TOP: (context, node, sum, rest): a node's mixed probability of a one.

    ``sum`` is the part of the estimates up to this depth, ``rest`` the weight left for extensions;
    an extension that was never seen has probability one half.
    """
    level = summed.mapInArrow(_grown, GROWN)
    levels = []
    for depth in range(TOP, -1, -1):
        if levels:
            above = levels[0].withColumn("context", F.col("context").bitwiseAND(F.lit((1 << 8 * depth) - 1)))
            level = above.groupBy("context", "node").agg(
                F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("children")
            )
        own = _estimate(F.col("zeros"), F.col("ones"))
        level = level.withColumn("own", own)
        most = F.greatest("own", "children")
        both = most + F.log(F.exp(F.col("own") - most) + F.exp(F.col("children") - most))
        level = level.withColumn("weighted", both - math.log(2))
        level = level.withColumn("stop", F.exp(F.col("own") - math.log(2) - F.col("weighted")))
        levels.insert(0, staged(level.drop("own", "children"), f"level{depth}"))
    mixtures = []
    for depth, level in enumerate(levels):
        tree = level
        one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
        level = level.select("context", "node", one.alias("one"), "stop")
        if not mixtures:
            level = level.withColumns({"given": F.lit(0.0), "left": F.lit(1.0)})
        else:
            parent = mixtures[-1].select(
                F.col("context").alias("parent"), "node", F.col("sum").alias("given"), F.col("rest").alias("left")
            )
            inner = F.col("context").bitwiseAND(F.lit((1 << 8 * (depth - 1)) - 1))
            level = level.withColumn("parent", inner).join(parent, ["parent", "node"]).drop("parent")
        total = F.col("given") + F.col("left") * F.col("stop") * F.col("one")
        above = level.select(
            "context", "node", total.alias("sum"), (F.col("left") * (1 - F.col("stop"))).alias("rest")
        )
        mixtures.append(staged(above, f"mixed{depth}"))
        unstaged(tree)
    return mixtures


def _added_up(asked: DataFrame, name: str) -> DataFrame:
    lists = asked.select("part", "size", "strings", "counts").repartition("part").sortWithinPartitions("part")
    summed = staged(lists.mapInArrow(_merged, SUMMED), name)
    freed(asked.sparkSession)
    return summed


def _answers(parts: list[DataFrame], kind: int, values_of: Callable) -> DataFrame:
    """Answers to the last table's lists; the tables are what a part reads, in order."""
    rows = None
    for what, table in enumerate(parts, TOPS + 3 - len(parts)):
        table = table.withColumn("what", F.lit(what))
        rows = table if rows is None else rows.unionByName(table, True)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _answered(batches, kind, values_of)

    return rows.repartition("part").sortWithinPartitions("part", "what").mapInArrow(answered, ANSWER)


def _probabilities(asked: DataFrame) -> DataFrame:
    """The lists of all blocks (block, part, size, strings, counts) with log10 of the probability of
    each string's last byte after the others."""
    summed = _added_up(asked, "strings")
    trees = _trees(summed)
    known = summed.mapInArrow(_wanted, WANTED).join(trees[TOP], ["context", "node"], "left")
    for depth in range(TOP - 1, -1, -1):
        one = (F.col("sum") + F.col("rest") * 0.5).alias("sum")
        shorter = trees[depth].select(F.col("context").alias("short"), "node", one, F.lit(0.0).alias("rest"))
        inner = F.col("context").bitwiseAND(F.lit((1 << 8 * depth) - 1))
        found = known.filter("sum IS NULL").drop("sum", "rest").withColumn("short", inner)
        found = found.join(shorter, ["short", "node"], "left").select("part", "context", "node", "sum", "rest")
        before, kept = known, known.filter("sum IS NOT NULL").select(*found.columns)
        known = staged(kept.unionByName(found), "known")
        if depth < TOP - 1:
            unstaged(before)
    tops = known.select(
        "part",
        "context",
        "node",
        F.coalesce("sum", F.lit(0.5)).alias("given"),
        F.coalesce("rest", F.lit(0.0)).alias("left"),
    )
    return _answers([tops, summed, asked], STRINGS, _values)


def _known(known: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    rows = known.filter(pc.equal(known.column("kind"), kind))
    lists = zip(*(rows.column(c).to_pylist() for c in ("size", "strings", "values")), strict=True)
    return _sorted([(_grams_of(s, size), _unpacked(v, size, np.float64)) for size, s, v in lists])


def _looked_up(numbers: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The values of numbers, looked up in ascending order, as places far apart are slow."""
    order = np.argsort(numbers)
    values = np.empty(len(numbers))
    values[order] = known[1][np.searchsorted(known[0], numbers[order])]
    return values


def _scored(docs: pa.Table, known: pa.Table, scale: float) -> pa.Table:
    """The scores of one block's documents from the values of its strings and the counts of its words."""
    strings, words = _known(known, STRINGS), _known(known, WORDS)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "bits_per_byte"]
    out = []
    for batch in docs.to_batches():
        for rows, texts in byte_chunks(batch, CHUNK):
            texts = [t.lower() for t in texts]
            grams, counts = _grams(texts)
            scores = np.add.reduceat(_looked_up(grams, strings), np.cumsum(counts) - counts)
            bits = -scores / math.log10(2) / counts
            tokens, sizes = _tokens(texts)
            seen, starts = _looked_up(tokens, words), np.cumsum(sizes) - sizes
            base = np.add.reduceat(np.log10((seen + 0.5) / scale), starts)
            n_known = np.add.reduceat((seen > 0).astype(np.int64), starts)
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        rows.column("held_out"),
                        pa.array(sizes, pa.int64()),
                        pa.array(n_known, pa.int64()),
                        pa.array(base, pa.float64()),
                        pa.array(scores),
                        pa.array(bits),
                    ],
                    names,
                )
            )
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), *[pa.float64()] * 3]
    return pa.Table.from_batches(out, pa.schema(list(zip(names, kinds, strict=True))))


def scored(docs: DataFrame) -> DataFrame:
    """Scores of all documents (doc_id, text), learned from those that are not held out.

    Held out is a document whose crc32 of the id as text leaves 1 modulo 5; a null id counts as the
    empty text. A null text is empty: it has the end alone. ``train_tokens`` is the number of
    training tokens; ``bits_per_byte`` the code length of the text's bytes and its end, per byte of both.
    Strings that share their last ``TOP`` context bytes are looked at in one task. Repeated rows each
    count and each get their row. Without training documents every binary decision has probability one
    half. An empty table gives an empty result; other columns are left behind.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    spread = F.pmod(F.xxhash64("doc_id", F.crc32(text.cast("binary"))), F.lit(blocks)).cast("int")
    rows = docs.select("doc_id", text.alias("text"), (fold == HELD_OUT).alias("held_out"), spread.alias("block"))
    rows = rows.repartition(min(blocks, MOST_TASKS), "block").sortWithinPartitions("block")
    parts = min(size // PART_BYTES + 1, MOST_PARTS)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _asked(batches, parts)

    asked = staged(rows.mapInArrow(listed, ASKED), "asked", "zstd")
    freed(docs.sparkSession)

    lists = asked.select("block", "part", "size", "strings", "counts")
    words = lists.filter(asked["kind"] == WORDS)
    counted = _added_up(words, "words")
    totals = counted.mapInArrow(_totals, "total long, known long")
    total, known = (n or 0 for n in totals.agg(F.sum("total"), F.sum("known")).first())
    answers = _answers([counted, words], WORDS, _counts)
    answers = answers.unionByName(_probabilities(lists.filter(asked["kind"] == STRINGS)))
    scale = total + 0.5 * (known + 1)

    def scored_block(documents: pa.Table, values: pa.Table) -> pa.Table:
        return _scored(documents, values, scale)

    done = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored_block, SCORED)
    return done.withColumn("train_tokens", F.lit(total).cast("long"))
