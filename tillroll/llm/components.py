"""Connected components by star contraction, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import staged


def _small_star(edges: DataFrame) -> DataFrame:
    """Join every node's smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.unionAll(own).filter("a > b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every node's larger neighbours to its smallest neighbour, or to itself."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is a component's smallest node."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = staged(edges.filter("a > b").distinct(), "edges")
    mark, last = F.struct(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")), None
    while True:
        now = edges.agg(mark).first()[0]
        if now == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = now
        edges = staged(_small_star(_large_star(edges)), "edges")
