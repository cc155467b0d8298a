"""What each of five filters removes in every order of applying them.

A document fails a set of filters, its mask. A mask alone decides what happens to the document at each
of the 600 steps (120 orders of five filters), so it stands for one wide integer: a field of 64 bits for
each step and outcome, 1 where the outcome holds. The integers of a part's documents are summed and the
sum is cut into its fields again. A field is a number of rows, which a long holds, so it never runs
over into the next.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import byte_chunks, staged

FILTERS = "ABCDE"
ORDERS = tuple("".join(order) for order in itertools.permutations(FILTERS))
OUTCOMES = ("kept", "removed", "redundant", "unique_fails")
FIELD = 8  # bytes of a field
CHUNK = 4 << 20

# Fixed values of the filters.
FEWEST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = b"#$%&*|"
REPEATED = 1 << FILTERS.index("E")

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in COUNTS)


def own_mask(text: bytes, points: int) -> int:
    """The filters a text of so many code points fails by itself: A, B, C and D."""
    words = text.split()  # at the six ASCII white space characters
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(words) < FEWEST_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > CAPITAL_PERCENT * points) << 2
        | any(sign in text for sign in SIGNS) << 3
    )


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in byte_chunks(batch, CHUNK):
            points = pc.fill_null(pc.utf8_length(rows.column("text")), 0).to_pylist()
            masks = map(own_mask, texts, points)
            digests = [hashlib.blake2b(text, digest_size=16).digest() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("part"), pa.array(digests), pa.array(masks, pa.int32())],
                names=["doc_id", "part", "digest", "mask"],
            )


@functools.cache
def outcomes(mask: int) -> int:
    """The wide integer of one document that fails the filters of ``mask``."""
    number, place = 0, 0
    for order in ORDERS:
        earlier = 0
        for letter in order:
            own = 1 << FILTERS.index(letter)
            fails, gone = bool(mask & own), bool(mask & earlier)
            for holds in (not fails and not gone, fails and not gone, fails and gone, mask == own):
                number |= holds << place
                place += 8 * FIELD
            earlier |= own
    return number


def unpacked(number: int) -> np.ndarray:
    """The fields of a sum of wide integers by order, step and outcome."""
    shape = (len(ORDERS), len(FILTERS), len(OUTCOMES))
    return np.frombuffer(number.to_bytes(FIELD * np.prod(shape), "little"), "<i8").reshape(shape)


def _audited(part: pa.Table) -> pa.Table:
    """The result rows of one part, from its number of rows for each mask: at most 32."""
    counts = part.select(["mask", "rows", "good", "toxic"]).to_pydict()
    wide = [outcomes(mask) for mask in counts["mask"]]
    # So many equal integers add up to their product.
    whole, good, toxic = (
        unpacked(sum(number * n for number, n in zip(wide, counts[name]))) for name in ("rows", "good", "toxic")
    )
    removed = OUTCOMES.index("removed")
    letters = np.array([list(order) for order in ORDERS])
    shapley = np.zeros(letters.shape, np.int64)
    for letter in FILTERS:
        shapley[letters == letter] = whole[:, :, removed][letters == letter].sum()
    fields = [whole[:, :, k] for k in range(len(OUTCOMES))]
    fields += [good[:, :, removed], toxic[:, :, removed], shapley]
    steps = len(FILTERS)
    return pa.table(
        {
            "part": pa.array([part.column("part")[0].as_py()] * letters.size, pa.string()),
            "filter_order": pa.array(np.repeat(np.array(ORDERS), steps)),
            "step": pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(ORDERS))),
            **{name: pa.array(field.ravel()) for name, field in zip(COUNTS, fields)},
        }
    )


def masked(docs: DataFrame) -> DataFrame:
    """Each document's ``doc_id``, ``part`` and ``mask`` of failed filters, bit 0 for A.

    E is failed by a document whose text stands under a smaller id, too. The smallest id of a text is
    found from partial minima, and documents are looked up by their own id, so that a text with very
    many copies is nowhere gathered.
    """
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).cast("string").alias("part"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = staged(rows.mapInArrow(_masks, f"doc_id {kind}, part string, digest binary, mask int"), "masks")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"))
    first = first.select("first", F.col("digest").alias("_digest"))
    known = rows.filter(F.col("doc_id").isNotNull())
    met = (F.col("doc_id") == F.col("first")) & (F.col("digest") == F.col("_digest"))
    known = known.join(first, met, "left").select(
        "doc_id", "part", F.when(F.col("first").isNull(), F.col("mask") + REPEATED).otherwise(F.col("mask")).alias("mask")
    )
    return known.unionByName(rows.filter(F.col("doc_id").isNull()).select("doc_id", "part", "mask"))


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts for each part (source), order of filters and step, zeros included.

    A null text is empty, a null source the part ``''``, together with empty sources. Repeated rows
    count each; rows with one id are no copies of each other. A document without an id fails E never
    and has no label; labels without an id are passed over. Of an id's repeated labels, one with
    quality 1 makes it good and one with toxic 1 toxic. Without documents there are no parts. Other
    columns are not read. A text is held whole while it is looked at. Texts are told apart by 128 bits.
    """
    marks = labels.select("doc_id", "quality", "toxic").filter(F.col("doc_id").isNotNull())
    marks = marks.groupBy(F.col("doc_id").alias("_labelled")).agg(
        F.bool_or(F.col("quality") == 1).alias("_good"), F.bool_or(F.col("toxic") == 1).alias("_toxic")
    )
    rows = masked(docs).select("doc_id", "part", "mask")
    known = rows.filter(F.col("doc_id").isNotNull())
    known = known.join(marks, F.col("doc_id") == F.col("_labelled"), "left").select("part", "mask", "_good", "_toxic")
    no = F.lit(False)
    other = rows.filter(F.col("doc_id").isNull()).select("part", "mask", no.alias("_good"), no.alias("_toxic"))
    counts = known.unionByName(other).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("_good").alias("good"),
        F.count_if("_toxic").alias("toxic"),
    )
    return counts.groupBy("part").applyInArrow(_audited, RESULT)
