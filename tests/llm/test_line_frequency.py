"""The limits of op5 as they stand, on a table where they remove lines and reject a document."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillroll.llm import quality
from tillroll.llm.oracles import ORACLES
from tillroll.llm.queries import QUERIES

COMMON = " ".join(f"menu{k}" for k in range(70))
DEPLETED = 900


def _own(i: int, n: int) -> str:
    return " ".join(f"own{i}x{k}" for k in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = [(i, f"{COMMON}\n{_own(i, 80)}", "large") for i in range(quality.LINE_DOCS + 10)]
    rows.append((DEPLETED, f"{COMMON}\n{_own(DEPLETED, 10)}", "large"))
    # As many as the limit, not more: the line stays.
    rows += [(1000 + i, f"{COMMON}\n{_own(1000 + i, 80)}", "small") for i in range(quality.LINE_DOCS)]
    path = str(tmp_path_factory.mktemp("lines"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"))
    docs.write.parquet(f"{path}/documents.parquet")
    return path


def test_production_limits_equal_sql(spark, folder):
    got = QUERIES["op5_line_frequency"](spark, folder)
    columns = sorted(got.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op5_line_frequency']})").fetchall()
    rows = got.select(*columns).collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in rows)
    gone = {r["doc_id"]: r["n_removed_words"] for r in rows}
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert gone[0] == 0 and gone[1] == 70 and gone[1000] == gone[999 + quality.LINE_DOCS] == 0
    assert [i for i, k in kept.items() if not k] == [DEPLETED]


def test_pipeline_stage_removes_the_lines(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.quality_rules(spark, docs, folder).collect()}
    assert DEPLETED not in left and len(left) == docs.count() - 1
    assert {i for i, t in left.items() if COMMON in t} == {0, *range(1000, 1000 + quality.LINE_DOCS)}
