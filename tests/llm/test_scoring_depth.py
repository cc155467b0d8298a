"""The trees of op2 look further back than four bytes."""

from __future__ import annotations

import zlib

from tillroll.llm import scoring


def test_scores_use_six_bytes_of_context(spark):
    # What follows "mnopq" is told by the byte before it, five bytes earlier than the next one.
    train = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 != 1]
    asked = [i for i in range(200, 400) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows = [(i, "amnopqx" if k % 2 else "bmnopqy") for k, i in enumerate(train)]
    rows += [(asked[0], "amnopqx"), (asked[1], "amnopqy")]
    found = scoring.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    score = {r["doc_id"]: r["score"] for r in found}
    assert score[asked[0]] > score[asked[1]] + 1
