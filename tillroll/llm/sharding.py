"""Consistent hashing with virtual nodes and bounded loads."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from tillroll.llm.common import shielded

CELLS = 1 << 14
VIRTUAL_NODES = 64

PIECE = T.StructType(
    [
        T.StructField("_cell", T.IntegerType(), False),
        T.StructField("_from", T.LongType(), False),
        T.StructField("_to", T.LongType(), False),
        T.StructField("_shard", T.IntegerType(), False),
        T.StructField("_slot", T.LongType(), False),
    ]
)


def ring(shards: int, virtual_nodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    spots = ((zlib.crc32(f"{s}/{v}".encode()), s) for s in range(shards) for v in range(virtual_nodes))
    return [(spot * cells >> 32, shard) for spot, shard in sorted(spots)]


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows that each shard may hold. Without slack they add up to all rows and differ by one at most."""
    if slack:
        return [int((1 + slack) * rows / shards) + 1] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def place(
    counts: dict[int, int], shards: int, virtual_nodes: int, cells: int, slack: float
) -> list[tuple[int, int, int, int, int]]:
    """Pieces (cell, first rank, end rank, shard, first slot) that cover every row of every cell.

    In a round each cell, in ring order, comes to the next virtual node clockwise whose shard has
    room at that moment, and its rows enter by rank until the shard is full. Those left go on from the
    node after it in the next round, when every other cell has had its turn.
    """
    nodes = ring(shards, virtual_nodes, cells)
    room = capacities(sum(counts.values()), shards, slack)
    used = [0] * shards
    ahead = list(range(len(nodes) + 1))  # ahead[i]: a node at or after i that may have room

    def open_node(i: int) -> int:
        """The first node at or after ``i``, going round, whose shard has room."""
        i %= len(nodes)
        passed = []
        while room[nodes[i][1]] == 0:
            passed.append(i)
            step = ahead[i] if ahead[i] != i else i + 1
            i = step % len(nodes)
        for p in passed:
            ahead[p] = i
        return i

    waiting, node = [], 0
    for cell in sorted(counts):
        while node < len(nodes) and nodes[node][0] < cell:
            node += 1
        waiting.append((cell, 0, counts[cell], node))
    pieces = []
    while waiting:
        refused = []
        for cell, start, end, at in waiting:
            at = open_node(at)
            shard = nodes[at][1]
            taken = min(room[shard], end - start)
            pieces.append((cell, start, start + taken, shard, used[shard]))
            used[shard] += taken
            room[shard] -= taken
            if start + taken < end:
                refused.append((cell, start + taken, end, at + 1))
        waiting = refused
    return pieces


def bounded_ring(
    rows: DataFrame,
    shards: int,
    key: str = "doc_id",
    order: Sequence[str] = (),
    virtual_nodes: int = VIRTUAL_NODES,
    cells: int = CELLS,
    slack: float = 0.0,
) -> DataFrame:
    """Every row with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    The key's hash gives a place on a ring of ``cells`` equal cells, and ``order`` breaks ties of
    equal keys. Rows are only ranked within their cell; which ranks of a cell go to which shard
    follows from the cells' counts, so the driver sees ``cells`` numbers at most, whatever the input.
    A null key is hashed like any other value. Repeated rows are placed one by one. An empty table
    gives an empty result. Columns named shard or slot are replaced; others stay, whatever their names.
    """
    spark = rows.sparkSession
    rows, restored = shielded(rows, list(dict.fromkeys([key, *order])), ["shard", "slot"])
    spot = F.xxhash64(F.col(key).cast("string"))
    cell = F.shiftrightunsigned(spot, 64 - (cells.bit_length() - 1)).cast("int")
    counted = rows.select(cell.alias("_cell")).groupBy("_cell").count().collect()
    pieces = place({r["_cell"]: r["count"] for r in counted}, shards, virtual_nodes, cells, slack)
    # Bounded by the ring's cells and virtual nodes, not by the rows.
    plan = F.broadcast(spark.createDataFrame(pieces, PIECE))
    within = Window.partitionBy("_cell").orderBy("_spot", key, *order)
    ranked = rows.withColumns({"_cell": cell, "_spot": spot})
    ranked = ranked.withColumn("_rank", F.row_number().over(within).cast("long") - 1)
    placed = ranked.join(plan, "_cell").filter("_rank >= _from AND _rank < _to")
    placed = placed.withColumns(
        {"shard": F.col("_shard"), "slot": F.col("_slot") + F.col("_rank") - F.col("_from")}
    )
    return restored(placed.drop("_cell", "_spot", "_rank", "_from", "_to", "_shard", "_slot"))


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """The shard of every document: counts differ by one at most (law ``rows``).

    A null text has no bytes and the checksum of the empty text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = bounded_ring(sized, shards, "doc_id", ["text_crc32", "size"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
