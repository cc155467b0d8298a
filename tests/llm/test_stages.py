"""Every stage of the pipeline on odd rows: nulls, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

INNER = ("_id", "_key", "_kept", "_cut", "_rest", "_found", "key", "node", "ids")
LONG = " ".join(f"w{k}" for k in range(80))
PASSAGE = " ".join(f"p{k}" for k in range(60))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stages"))
    items = [(1, " ".join(f"b{k}" for k in range(12))), (2, None), (2, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark):
    texts = [
        (1, LONG),
        (2, f"{LONG} end"),  # near 1
        (3, None),
        (4, ""),
        (5, f"� start {' '.join(f'x{k}' for k in range(90))} {PASSAGE}"),
        (6, f"� other {' '.join(f'y{k}' for k in range(90))} {PASSAGE} é�"),
        (6, f"� other {' '.join(f'y{k}' for k in range(90))} {PASSAGE} é�"),
        (7, f"{' '.join(f'z{k}' for k in range(90))} {' '.join(f'b{k}' for k in range(12))}"),
        (None, " ".join(f"n{k}" for k in range(70))),
    ]
    rows = [(i, t, "en", None if i == 7 else "h", len(t or "")) for i, t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *(F.lit("clash").alias(name) for name in INNER))


def ids(df):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in df.select("doc_id").collect())


def want(*numbers):
    return sorted((n is not None, n or 0) for n in numbers)


def test_stages_on_odd_rows(spark, docs, folder):
    kept = {
        "quality rules": want(1, 2, 5, 6, 6, 7, None),
        "near-duplicates": want(1, 3, 4, 5, 6, 7, None),
        "repeated passages": want(1, 2, 3, 4, 5, 6, 6, 7, None),
        "benchmark items": want(1, 2, 3, 4, 5, 6, 6, None),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert tuple(found.columns) == corpus_pipeline.COLUMNS
        assert ids(found) == kept[name], name
        assert stage(spark, docs.limit(0), folder).isEmpty()
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, docs, folder).select("doc_id").distinct().count() == 8
    assert stage(spark, docs.limit(0), folder).isEmpty()


def test_signs_of_the_source_stay_beside_a_cut(spark, docs, folder):
    left = corpus_pipeline.repeated_passages(spark, docs, folder)
    texts = {r["doc_id"]: r["text"] for r in left.filter("doc_id > 4").collect()}
    assert PASSAGE in texts[5] and PASSAGE not in texts[6]
    assert texts[6].startswith("� other y0") and texts[6].endswith("é�")
    assert {r["n_chars"] for r in left.filter("doc_id = 6").collect()} == {len(texts[6])}
    assert left.filter("doc_id = 3 AND text IS NULL").count() == 1
