"""The lists in which blocks of op2 hand their strings and words to the parts."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute

from tillroll.llm import scoring


def _counted(texts):
    front = b"\0" * scoring.DEPTH
    strings, words = Counter(), Counter()
    for text in texts:
        data = front + text.encode().lower() + b"\0"
        strings.update(data[i - scoring.DEPTH : i + 1] for i in range(scoring.DEPTH, len(data)))
        words.update(text.lower().split() + [""])
    return strings, words


def _bytes_of(grams):
    plain = scoring._plain(grams)
    return [int(x).to_bytes(scoring.DEPTH + 1, "big") for x in plain]


def _asked(rows, parts):
    """(block, held out, text) rows in batches of two."""
    kinds = pa.schema([("block", pa.int32()), ("held_out", pa.bool_()), ("text", pa.string())])
    table = pa.Table.from_pylist([dict(zip(kinds.names, r, strict=True)) for r in rows], kinds)
    return pa.Table.from_batches(list(scoring._asked(iter(table.to_batches(2)), parts)))


ROWS = [
    (0, False, "the cat sat on the mat"),
    (0, False, "THE cat"),
    (0, True, "an unseen word"),
    (3, False, ""),
    (3, False, "the mat, the mat é"),
    (3, True, "the cat sat"),
]


def _merged(asked, kind):
    mine = asked.filter(pa.compute.equal(asked.column("kind"), kind)).sort_by("part")
    mine = mine.select(["part", "size", "strings", "counts"]).combine_chunks()
    return list(scoring._held(scoring._merged(iter(mine.to_batches(1)))))


def test_numbers_come_back_from_lists():
    rng = np.random.default_rng(1)
    for numbers in (np.zeros(1, np.int64), np.sort(rng.integers(-(1 << 63), (1 << 63) - 1, 1000))):
        assert (scoring._grams_of(scoring._listed(numbers), len(numbers)) == numbers).all()
    values = rng.normal(size=100)
    assert (scoring._unpacked(scoring._packed(values), 100, np.float64) == values).all()


def test_parts_add_up_the_lists_of_all_blocks():
    strings, words = _counted([text for _, held, text in ROWS if not held])
    every, tokens = _counted([text for *_, text in ROWS])
    for parts in (1, 3, 50):
        asked = _asked(ROWS, parts)
        found = {}
        for _, grams, n in _merged(asked, scoring.STRINGS):
            for gram, count in zip(_bytes_of(grams), n.tolist(), strict=True):
                assert gram not in found
                found[gram] = count
        assert found == {gram: strings[gram] for gram in every}
        counts = sorted(x for _, _, n in _merged(asked, scoring.WORDS) for x in n.tolist())
        assert counts == sorted(words[w] for w in tokens)


def test_lists_cut_no_context_apart(monkeypatch):
    monkeypatch.setattr(scoring, "GROUP_ROWS", 3)
    monkeypatch.setattr(scoring, "LIST_ROWS", 2)
    monkeypatch.setattr(scoring, "HELD_ROWS", 4)
    lists = _merged(_asked(ROWS, 2), scoring.STRINGS)
    assert len(lists) > 5
    seen = set()
    for _, grams, _ in lists:
        contexts = {gram[-scoring.TOP - 1 : -1] for gram in _bytes_of(grams)}
        assert not contexts & seen
        seen |= contexts
    every, _ = _counted([text for *_, text in ROWS])
    assert sum(len(grams) for _, grams, _ in lists) == len(every)
