"""Token ids in files: ids ranked by frequency, ranks in variable-length bytes.

A rank takes one to four bytes, without those that are zero at its high end. How many stands apart, in
two bits per rank, four to a control byte. Frequent ids have small ranks and so take one byte. A
reader looks up four lengths for each control byte in a table, adds them up to places, and
gathers the bytes; there is no loop over ids.

The files are two Parquet tables below one folder: ``ranks`` (rank, id, n) and ``blocks`` (part, block,
doc_ids, lengths, control, data). A block holds whole documents in ascending order of ids; parts
and blocks are ascending too.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import row_chunks
from tillroll.llm.tokens import lower_words
from tillroll.storage import new_folder

BLOCK_TOKENS = 256 << 10
PARTITION_BYTES, MOST_TASKS = 16 << 20, 8192  # a task takes its blocks one after the other
CHUNK = 8 << 20  # of text, whose pieces are told apart at once

PLAIN = "part int, block int, doc_ids array<long>, lengths array<long>, ids binary"
CODED = "part int, block int, doc_ids array<long>, lengths array<long>, control binary, data binary"

# The lengths of the four ranks of every control byte.
LENGTHS = (np.arange(256)[:, None] >> (2 * np.arange(4)) & 3).astype(np.int64) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of a run of ranks."""
    ranks = ranks.astype("<u4")
    width = max(1, -(-int(ranks.max(initial=0)).bit_length() // 8))  # no rank here has more bytes
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    extra = padded[: len(ranks)]
    for k in range(1, width):
        extra += ranks >= 1 << 8 * k
    first, second, third, fourth = padded.reshape(-1, 4).T
    control = first | second << 2 | third << 4 | fourth << 6
    taken = np.arange(width) <= extra[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[:, :width][taken].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    places = np.cumsum(lengths) - lengths
    held = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = held[places].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(lengths > k)
        if not len(more):
            break
        ranks[more] |= held[places[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def _tokenized(vocabulary: str, end_id: int) -> Callable:
    """Blocks of plain ids, 32 bits each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = lower_words(vocabulary)
        part, block, names, held = TaskContext.get().partitionId(), 0, [], []
        end = np.array([end_id], tokenizer.dtype).tobytes()

        def flushed() -> pa.RecordBatch:
            lengths = [len(ids) // tokenizer.dtype.itemsize for ids in held]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([b"".join(held)], pa.binary()),
                ],
                ["part", "block", "doc_ids", "lengths", "ids"],
            )

        size = 0
        for batch in batches:
            for rows in row_chunks(batch, CHUNK):
                # The vocabulary drops case; without A-Z there are fewer pieces to remember.
                found = tokenizer.encode(pc.ascii_lower(rows.column("text")))
                for name, ids in zip(rows.column("doc_id").to_pylist(), found, strict=True):
                    names.append(name)
                    held.append(ids + end)
                    size += len(held[-1])
                    if size >= BLOCK_TOKENS * tokenizer.dtype.itemsize:
                        yield flushed()
                        block, names, held, size = block + 1, [], [], 0
        if held:
            yield flushed()

    return run


def _counts(vocabulary: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype, total = lower_words(vocabulary).dtype, np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                more = np.bincount(np.frombuffer(ids.as_buffer(), dtype), minlength=len(total))
                more[: len(total)] += total
                total = more
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])

    return run


def _coded(vocabulary: str, rank_of) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype, table = lower_words(vocabulary).dtype, rank_of.value
        for batch in batches:
            made = [
                encode_ranks(table[np.frombuffer(ids.as_buffer(), dtype)]) for ids in batch.column("ids")
            ]
            columns = batch.select(["part", "block", "doc_ids", "lengths"]).columns
            streams = [pa.array(s, pa.binary()) for s in zip(*made, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*columns, *streams], ["part", "block", "doc_ids", "lengths", "control", "data"]
            )

    return run


def write_ids(docs: DataFrame, vocabulary: str, end_id: int, folder: str) -> None:
    """Write the ids of all documents (doc_id, text) below ``folder``, in ascending order of doc_id.

    Every document ends with ``end_id``; a null or empty text is that id alone. Null ids come
    first, repeated rows stay, an empty table gives empty tables, other columns are left behind.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = rows.repartitionByRange(min(size // PARTITION_BYTES + 1, MOST_TASKS), "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    plain = f"{folder}/plain"
    made = ordered.mapInArrow(_tokenized(vocabulary, end_id), PLAIN)
    made.write.option("compression", "lz4").parquet(plain)

    blocks = spark.read.schema(PLAIN).parquet(plain)
    counts = blocks.select("ids").mapInArrow(_counts(vocabulary), "id long, n long")
    counts = counts.groupBy("id").agg(F.sum("n").alias("n")).collect()  # one row per used id
    ranked = sorted(((r["n"], r["id"]) for r in counts), key=lambda x: (-x[0], x[1]))
    table = [(rank, number, n) for rank, (n, number) in enumerate(ranked)]
    spark.createDataFrame(table, "rank long, id long, n long").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max([0, *(number for _, number, _ in table)]) + 1, np.uint32)
    for rank, number, _ in table:
        rank_of[number] = rank
    shared = spark.sparkContext.broadcast(rank_of)
    coded = blocks.mapInArrow(_coded(vocabulary, shared), CODED)
    coded.write.option("compression", "none").parquet(f"{folder}/blocks")


def _decoded(id_of) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = id_of.value
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                ids = table[decode_ranks(row["control"], row["data"], int(lengths.sum()))]
                ends = np.cumsum(lengths)
                starts = ends - lengths
                sums = [zlib.crc32(ids[s:e]) for s, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ends), row["part"]), pa.int32()),
                        pa.array(np.full(len(ends), row["block"]), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["part", "block", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    return run


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 of its decoded ids.

    ``start`` counts the ids of all documents before it: blocks add up within their part, and parts
    before each other; only the parts' totals, one number each, meet in one task.
    """
    ranks = spark.read.parquet(f"{folder}/ranks").collect()  # bounded by the vocabulary
    id_of = np.zeros(len(ranks), "<u4")
    for row in ranks:
        id_of[row["rank"]] = row["id"]
    blocks = spark.read.schema(CODED).parquet(f"{folder}/blocks")
    sizes = blocks.select("part", "block", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("add"))
    offsets = offsets.join(parts, "part").select("part", "block", (F.col("base") + F.col("add")).alias("base"))
    shared = spark.sparkContext.broadcast(id_of)
    docs = blocks.mapInArrow(
        _decoded(shared),
        "part int, block int, doc_id long, within long, n_tokens long, ids_crc32 long",
    )
    return docs.join(offsets, ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write all documents to a new shared folder and read them back."""
    folder = new_folder(docs.sparkSession, "ids")
    write_ids(docs, vocabulary, end_id, folder)
    return read_ids(docs.sparkSession, folder)
