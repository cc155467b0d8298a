"""Extra columns named like the operators' own working columns, and what stays of working tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillroll import storage
from tillroll.llm import audit, decontaminate, language, neardup, packing, quality, scoring, search, sharding, suffixes, urls
from tillroll.llm.common import finished, shielded, staged

import public_tokenizers

INNER = [
    "_from", "_to", "_cell", "_spot", "_rank", "_shard", "_slot", "_doc", "_host", "_text", "_key", "_places", "_gone",
    "_counts", "_url", "_day", "_active", "_best", "_id", "_found", "_whole", "key", "node", "block", "mark", "digest",
    "mask", "part", "first", "_digest", "item", "rank", "_group", "drawn", "_limit", "size", "_other0", "a.b",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "one two three four five six", "en", "h"), (2, None, None, None), (2, "one two three four five six", "de", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.select("*", *(F.lit(f"own {name}").alias(name) for name in INNER))


def test_operators_ignore_or_keep_extra_columns(spark, docs):
    items = docs.select(F.col("doc_id").alias("item_id"), "text", *(f"`{name}`" for name in INNER))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"), *(f"`{name}`" for name in INNER))
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    for found, rows in (
        (sharding.shard_documents(docs, 2), 3),
        (neardup.near_duplicates(docs), 3),
        (suffixes.repeats_removed(docs), 3),
        (decontaminate.contaminated(docs, items), 4),
        (audit.interactions(docs, labels), 1200),
        (language.identified(docs), 3),
        (search.best_documents(docs, items), 4),
        (scoring.scored(docs), 3),
        (packing.packed(docs, vocabulary, end_id=1), 3),
    ):
        assert found.count() == rows


def own(df):
    names = [name for name in INNER if name in df.columns]
    rows = df.select(*(F.col(f"`{name}`") for name in names)).collect()
    return set(names), all(row[k] == f"own {name}" for row in rows for k, name in enumerate(names))


def test_other_columns_come_back(spark, docs):
    placed = sharding.bounded_ring(docs, 2)
    assert placed.columns == [*docs.columns, "shard", "slot"]
    assert own(placed) == (set(INNER), True)
    for with_text in (True, False):
        kept = quality.judged(docs.withColumn("n_words", F.lit("replaced")), with_text=with_text)
        assert own(kept) == (set(INNER), True) and ("text" in kept.columns) == with_text
        assert {row["n_words"] for row in kept.collect()} == {0, 6}
    captures = docs.select(F.lit("http://a.b/c").alias("url"), F.current_date().alias("day"), *(f"`{n}`" for n in INNER))
    entries = spark.createDataFrame([], "pattern string, day date, action string")
    seen = urls.filtered(captures, entries)
    assert own(seen) == (set(INNER), True) and seen.count() == 3


def test_shielded_keeps_the_order_of_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b int, a int, c int")
    inner, restored = shielded(df, ["a"], ["c"])
    assert inner.columns == ["a", "_other0"]
    assert restored(inner.withColumn("c", F.lit(9))).columns == ["b", "a", "c"]


def test_working_tables_go_when_their_operator_has_finished(spark):
    folder = Path(storage.shared_folder(spark).removeprefix("file:"))

    def left():
        return {path.name.rpartition("-")[0] for path in folder.glob("*-*")}

    before = left()

    def build():
        kept = staged(staged(spark.range(5), "inner_one"), "inner_two")
        assert {"inner_one", "inner_two"} <= left()
        return kept

    assert finished(spark, "outcome", build).count() == 5
    assert left() - before == {"outcome"}
    with pytest.raises(ZeroDivisionError):
        finished(spark, "outcome2", lambda: staged(spark.range(5), "inner_three") and 1 / 0)
    assert left() - before == {"outcome"}


def test_texts_after_cuts_keep_the_signs_of_the_source(spark):
    rows = [(1, 5, "a�b".encode() + "é".encode()[:1]), (2, 6, "é".encode()[1:] + b"x"), (3, 7, None), (4, 8, b"")]
    removed = spark.createDataFrame([(i, k, None if b is None else bytearray(b)) for i, k, b in rows], "doc_id long, key int, kept binary")
    found = {r["doc_id"]: r["text"] for r in suffixes.kept_texts(removed).collect()}
    assert found == {1: "a�b", 2: "x", 4: ""}
