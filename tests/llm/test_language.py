"""Language identification: phrases against plain cross-parsing, and held-out accuracy."""

import random
import zlib

import duckdb
import numpy as np

from tillroll.llm import language
from tillroll.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, held_out string, lang_pred long, drawn long"
SF = "/root/testdata/sf0.01"


def phrases(text, sample):
    """Longest prefixes that the sample holds, block by block; a foreign byte is a phrase."""
    count = 0
    for start in range(0, len(text), language.BLOCK):
        block = text[start : start + language.BLOCK]
        while block:
            n = 1
            while n < len(block) and block[: n + 1] in sample:
                n += 1
            block, count = block[n:], count + 1
    return count


def test_automaton_counts_the_longest_matches():
    draw = random.Random(3)
    for letters in ("ab", "abc ", "abcdefgh"):
        sample = "".join(draw.choices(letters, k=700)).encode()
        texts = ["".join(draw.choices(letters + "z", k=n)).encode() for n in (1, 2, 511, 512, 513, 3000)]
        texts += [sample[100:400], sample * 3, b"z" * 40]
        found = language.entropies(texts, (("x", sample),))[:, 0]
        plain = [phrases(text, sample) * np.log2(len(sample) + 1) / len(text) for text in texts]
        assert np.allclose(found, plain)


def rows_of(spark, rows):
    rows = [(i, text, lang, "src", "clash", 5, 6) for i, text, lang in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_odd_rows(spark):
    known = [(i, "the cat and the dog went out", "en") for i in range(20)]
    known += [(i, "der hund und die katze gehen", "de") for i in range(20, 40)]
    known += [(i, text, None) for i, text in enumerate(["the dog", "die katze"], 40)]
    odd = [
        (50, None, "en"),
        (51, "", "en"),
        (52, "12 34 !? _ ½", "de"),
        (53, "и", None),
        (None, "THE CAT", None),
        (54, "the dog and " * 20_000, None),
        (54, "the dog and " * 20_000, None),
    ]
    found = language.identified(rows_of(spark, known + odd))
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = found.collect()
    assert len(found) == len(known) + len(odd)
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1 if row.doc_id is not None else False)
        assert 0 <= row.score <= 1
    by_id = {row.doc_id: (row.lang_pred, row.score) for row in found}
    assert by_id[50] == by_id[51] == by_id[52] == ("und", 0.0)
    assert by_id[53] == ("de", 0.0)  # equally far from both
    assert [by_id[i][0] for i in (40, 41, None, 54)] == ["en", "de", "en", "en"]


def test_nothing_or_one_language_learnt(spark):
    rows = [(i, "some words", None) for i in range(5)]
    assert {(r.lang_pred, r.score) for r in language.identified(rows_of(spark, rows)).collect()} == {("und", 0.0)}
    rows += [(i, "some other words", "xx") for i in range(5, 20)]
    assert {(r.lang_pred, r.score) for r in language.identified(rows_of(spark, rows)).collect()} == {("xx", 1.0)}
    assert language.identified(rows_of(spark, rows).limit(0)).isEmpty()


def test_held_out_labels_are_not_learnt(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, "some words here", "kept out" if i in held else "learnt") for i in range(60)]
    found = language.identified(rows_of(spark, rows)).collect()
    assert {row.lang_pred for row in found} == {"learnt"}


def test_sample_is_bounded_and_shared(spark):
    rows = [(i, f"word{i} " * 50 if i % 2 else f"wort{i} " * 900, "en" if i % 2 else "de") for i in range(400)]
    samples = dict(language.samples_of(rows_of(spark, rows), 2000))
    assert set(samples) == {"de", "en"}
    assert all(900 < len(text) <= 1000 for text in samples.values())


def test_held_out_accuracy(spark):
    found = QUERIES["op12_cross_parsing"](spark, SF).collect()
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    assert len(found) == len(truth)
    unseen = [row for row in found if row.held_out]
    assert sum(truth[row.doc_id] == row.lang_pred for row in unseen) >= 0.99 * len(unseen)
