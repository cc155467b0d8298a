"""Ranked search against brute force: ties, odd rows, several blocks, tiles and digits."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item_id string, rank string, item int, score string"
ITEMS = "item_id long, text string, doc_id string, rank string"


def lowered(text):
    return re.sub("[A-Z]", lambda found: found[0].lower(), text or "")


def expected(docs, items, most=20):
    counted = [(i, TERM.findall(lowered(text))) for i, text in docs]
    counted = [(i, Counter(found), len(found)) for i, found in counted if found]
    n_docs, all_terms = len(counted), sum(n for *_, n in counted)
    holding = Counter(term for _, tf, _ in counted for term in tf)
    out = []
    for item_id, text in {*items}:
        asked = TERM.findall(lowered(text))
        scores = []
        for doc_id, tf, n in counted:
            m = 75 + (25 * n * n_docs) // all_terms
            score = 0
            for term in asked:
                if tf[term]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[term] + 1)))
                    score += weight * ((10**9 * tf[term]) // (1000 * tf[term] + 12 * m))
            if score:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, k, one[3], -one[0]) for k, one in enumerate(sorted(scores, key=lambda s: s[:3])[:most], 1)]
    return sorted(out, key=str)


def tables(spark, docs, items):
    docs = spark.createDataFrame([(i, text, "x", "x", 1, "x") for i, text in docs], DOCS)
    return docs.repartition(5), spark.createDataFrame([(i, text, "x", "x") for i, text in items], ITEMS)


def made():
    draw = random.Random(8)
    vocabulary = [f"t{k}" for k in range(60)] + ["Été", "x2", "né_e", "ÀB", "don't"]
    docs = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 30)))) for i in range(300)]
    docs += [(i, "t1 t2, T3;t4") for i in range(400, 460)]  # a border tie of equal texts
    docs += [(500, None), (501, ""), (502, " .,\x00\x7f"), (503, "t5 " * 40_000), (400, "t1 t2, T3;t4"), (None, "t1 t2 t3 t4")]
    items = [(k, " ".join(draw.choices(vocabulary, k=12))) for k in range(30)]
    items += [(40, "t1 t2 t3 t4"), (41, None), (42, "?!"), (43, "unheard of"), (44, "t5 " * 3000), (45, "t1"), (45, "t1"), (None, "t2")]
    return docs, items


def found(spark, docs, items):
    got = search.best_documents(*tables(spark, docs, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def test_ranks_equal_brute_force(spark):
    docs, items = made()
    assert found(spark, docs, items) == expected(docs, items)


def test_small_blocks_tiles_and_chunks_change_nothing(spark, monkeypatch):
    docs, items = made()
    monkeypatch.setattr(search, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(search, "BLOCK_TERMS", 40)
    assert found(spark, docs, items[:20]) == expected(docs, items[:20])


def test_empty_tables(spark):
    docs, items = tables(spark, *made())
    assert search.best_documents(docs.limit(0), items).isEmpty()
    assert search.best_documents(docs, items.limit(0)).isEmpty()


@pytest.mark.parametrize("width", [1, 3, 4096])
def test_tiles_add_up_exactly(width):
    draw = np.random.default_rng(1)
    weights = draw.integers(0, 2**38, (4, 10))
    weights[:, 3] = 2**38
    impact = draw.integers(0, search.IMPACT, (10, 6))
    scores = np.zeros((4, 6), np.int64)
    for span, digits in search.tiles(weights, width):
        for shift, digit in digits:
            product = digit @ impact[span].astype(np.float64)
            assert product.max() < 2**53
            scores += product.astype(np.int64) << shift
    exact = [[sum(int(a) * int(b) for a, b in zip(row, col)) for col in impact.T] for row in weights]
    assert scores.tolist() == exact


def test_best_keeps_the_smallest_ids_of_equal_scores():
    best = search.Best(1, 2)
    for ids in ([9, 4], [7, 1], [8, 3]):
        best.add(np.array([[5, 5]]), np.array(ids), np.array([False, False]))
    assert best.doc.tolist() == [1, 3]
