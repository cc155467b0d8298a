"""Scores of op2 against a plain context-tree weighting and the unigram formula."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest

from tillroll.llm import scoring

TEXTS = [
    "the cat sat on the mat",
    "the cat sat on the MAT, the dog sat too",
    "abababababab abababab",
    "a long way to the sea and a long way back",
    "",
    None,
    "é ü é ü",
    "the dog",
    "only held out words: zyx wvu",
    "the cat sat on the mat",
    "dogs and cats",
    "QQQQ",
]


def _held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 == 1


def _decisions(text, depth):
    """(contexts of 0 to depth bytes, node, bit) of every binary decision of a text."""
    data = b"\0" * depth + (text or "").encode().lower() + b"\0"
    for i in range(depth, len(data)):
        contexts = [data[i - d : i] for d in range(depth + 1)]
        node = 1
        for k in range(7, -1, -1):
            bit = data[i] >> k & 1
            yield contexts, node, bit
            node = 2 * node + bit


def _estimated(zeros, ones):
    gamma = math.lgamma
    return gamma(zeros + 0.5) + gamma(ones + 0.5) - gamma(zeros + ones + 1) - math.log(math.pi)


class Trees:
    def __init__(self, texts, depth):
        self.depth, counts = depth, defaultdict(lambda: [0, 0])
        for text in texts:
            for contexts, node, bit in _decisions(text, depth):
                for c in contexts:
                    counts[c, node][bit] += 1
        self.counts, self.children, self.weighted = counts, defaultdict(float), {}
        for c, node in sorted(counts, key=lambda x: -len(x[0])):
            self.weighted[c, node] = self._mixed(c, node, counts[c, node], self.children[c, node])
            if c:
                self.children[c[1:], node] += self.weighted[c, node]

    def _mixed(self, c, node, counts, children):
        own = _estimated(*counts)
        if len(c) == self.depth:
            return own
        top = max(own, children)
        return top + math.log((math.exp(own - top) + math.exp(children - top)) / 2)

    def log_of(self, contexts, node, bit):
        """What one more decision multiplies the root's weighted probability by."""
        below = 0.0
        for c in reversed(contexts):
            counts = list(self.counts.get((c, node), (0, 0)))
            counts[bit] += 1
            before = self.weighted.get((c, node), 0.0)
            after = self._mixed(c, node, counts, self.children.get((c, node), 0.0) + below)
            below = after - before
        return below / math.log(10)


def _rows():
    rows = [(i, t) for i, t in enumerate(TEXTS * 2)] + [(None, "the null id")]
    held = next(i for i in range(100, 200) if _held_out(i))
    return [*rows, (0, TEXTS[0]), (held, "the unseen word xyzzy ~~~~"), (held, "the unseen word xyzzy ~~~~")]


def _expected(rows, depth):
    trained = [t for i, t in rows if not _held_out(i)]
    trees = Trees(trained, depth)
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    counts = Counter(w for t in trained for w in tokens(t))
    total, known = counts.total(), len(counts)
    for doc_id, text in rows:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (known + 1))) for w in tokens(text))
        score = sum(trees.log_of(*x) for x in _decisions(text, depth))
        seen = sum(counts[w] > 0 for w in tokens(text))
        yield (doc_id, _held_out(doc_id), len(tokens(text)), seen, total, base, score)


def _key(row):
    return repr(row[:5]), row[6]


def _same(frame, rows):
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = sorted((tuple(r[n] for n in names) for r in frame.collect()), key=_key)
    want = sorted(_expected(rows, scoring.DEPTH), key=_key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_scores_equal_plain_weighting(spark):
    rows = _rows()
    assert {_held_out(i) for i, _ in rows} == {True, False}
    _same(scoring.scored(spark.createDataFrame(rows, "doc_id long, text string")), rows)
