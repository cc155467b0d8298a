"""Registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm import (
    audit,
    binary,
    chat,
    decontaminate,
    language,
    neardup,
    packing,
    quality,
    scoring,
    search,
    sharding,
    suffixes,
    urls,
)
from tillroll.llm.common import finished, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_context_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(spark, "op2", lambda: scoring.scored(table(spark, sf_dir, "documents")))


def op3_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    return finished(
        spark, "op3", lambda: neardup.near_duplicates(table(spark, sf_dir, "documents")).select(*columns)
    )


def op4_url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.filtered(urls.captures_of(pages), urls.entries_of(pages)).drop("url")


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality.judged(table(spark, sf_dir, "documents"), with_text=False)
    return verdicts.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_removed_words",
    )


def op6_byte_aligned_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return binary.round_trip(table(spark, sf_dir, "documents"), vocabulary, end_id=2)


def op7_merged_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digests() -> DataFrame:
        found = suffixes.repeats_removed(table(spark, sf_dir, "documents"))
        digest = F.when(F.col("kept").isNull(), F.col("sha")).otherwise(F.sha2("kept", 256))
        return found.select("doc_id", "n_bytes", "n_removed", "n_spans", digest.alias("kept_sha256"))

    return finished(spark, "op7", digests)


def op8_ordered_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.packed(table(spark, sf_dir, "documents"), vocabulary, end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "'\\\\### Assistant: </turn> ok'"
    added = spark.sql(
        f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, {said} AS text "
        f"UNION ALL SELECT -7L, 1L, 'assistant', {said}"
    )
    turns = table(spark, sf_dir, "conversations").select(*added.columns).unionByName(added)
    return chat.digests(chat.read_back(chat.formatted(turns)))


def op10_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return finished(spark, "op10", lambda: decontaminate.contaminated(docs, items).drop("key"))


def op11_wide_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return finished(spark, "op11", lambda: audit.interactions(docs, labels))


def op12_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op13_dense_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_ring": op1_ring,
    "op2_context_trees": op2_context_trees,
    "op3_tensored_minhash": op3_tensored_minhash,
    "op4_url_list": op4_url_list,
    "op5_line_frequency": op5_line_frequency,
    "op6_byte_aligned_ids": op6_byte_aligned_ids,
    "op7_merged_suffixes": op7_merged_suffixes,
    "op8_ordered_windows": op8_ordered_windows,
    "op9_grammar": op9_grammar,
    "op10_containment": op10_containment,
    "op11_wide_counters": op11_wide_counters,
    "op12_cross_parsing": op12_cross_parsing,
    "op13_dense_tiles": op13_dense_tiles,
}
