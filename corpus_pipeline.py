"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm import decontaminate, neardup, packing, quality, suffixes
from tillroll.llm.common import finished, same, table, unstaged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of documents; n_chars follows the text."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that are frequent in their host.

    Null and empty texts have no words and go. Null sources are one host. Repeated rows get the same
    verdict and stay repeated. An empty table stays empty. Columns other than those of documents are
    left behind, here and in every stage.
    """
    return _documents(quality.judged(docs.select(*COLUMNS)).filter("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Documents without words are in no group and stay. Rows that repeat an id and text become one row.
    Null ids take part and give way to any other. An empty table stays empty.
    """
    rows = docs.select(*COLUMNS)

    def kept() -> DataFrame:
        found = neardup.near_duplicates(rows).filter("kept")
        return found.select(F.col("doc_id").alias("_id"), F.col("key").alias("_kept")).distinct()

    found = finished(spark, "kept", kept)
    rows = rows.withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    met = same(F.col("doc_id"), F.col("_id")) & (F.col("_key") == F.col("_kept"))
    return rows.join(found, met, "left_semi").dropDuplicates(["doc_id", "_key"]).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that an earlier document holds, and none that were all that.

    Bytes of a character that was cut through go, too; everything else that stands beside a cut stays
    as it was. Documents in which nothing repeats are unchanged, null and empty texts too. Repeated rows
    get the same text. Null ids come first. An empty table stays empty.
    """
    rows = docs.select(*COLUMNS)

    def cut() -> DataFrame:
        changed = suffixes.kept_texts(suffixes.repeats_removed(rows).filter("n_removed > 0"))
        return changed.select(F.col("doc_id").alias("_id"), F.col("key").alias("_cut"), F.col("text").alias("_rest"))

    found = finished(spark, "cut", cut)
    rows = rows.withColumn("_key", F.hash(F.coalesce("text", F.lit(""))))
    met = same(F.col("doc_id"), F.col("_id")) & (F.col("_key") == F.col("_cut"))
    rows = rows.join(found, met, "left").filter("_cut IS NULL OR _rest <> ''")
    text = F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.col("_rest"))
    return _documents(rows.withColumn("text", text))


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Null and empty texts hold none. Repeated rows get the same verdict and stay repeated. Null ids take
    part. An empty table, or an empty benchmark, leaves all documents there are.
    """
    rows = docs.select(*COLUMNS)

    def holding() -> DataFrame:
        found = decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark"))
        return found.select(F.col("doc_id").alias("_id"), F.col("key").alias("_found")).distinct()

    found = finished(spark, "found", holding)
    rows = rows.withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    met = same(F.col("doc_id"), F.col("_id")) & (F.col("_key") == F.col("_found"))
    return rows.join(found, met, "left_anti").select(*COLUMNS)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of at most 2048 ids.

    Null and empty texts have their end alone. Repeated rows are packed each, null ids come first. An empty
    table gives no pieces.
    """
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark items", benchmark_items),
    ("packing", packed_windows),
]

# Near-duplicates by MinHash, byte-wise removal and packing have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again by the next; what no stage reads any more goes."""
    docs = before = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        done = finished(spark, f"stage{k}", partial(stage, spark, docs, sf_dir))
        if docs is not before:
            unstaged(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
