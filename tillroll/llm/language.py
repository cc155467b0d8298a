"""The language of a text by cross-parsing: how few phrases of a language's labelled text make it up.

For each language a suffix automaton recognises every string of a sample of its labelled text. A
document is read letter by letter; a phrase goes on as long as the automaton recognises it, so it is the
longest match from where it began. A text in the language of the sample needs few phrases. Their number
times the bits that name a place in the sample, per byte, estimates the cross entropy, and the
language of the smallest wins.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Characters of labelled text that the automata of all languages together are made of. A language
# has an equal share, so that their phrases compare.
SAMPLE = 1 << 18
# Of one document, a sample takes at most so many characters.
PIECE = 4096
# The sample is drawn by a hash of the text, and more is drawn than kept, as lengths differ.
SPARE = 4

# Bytes that are parsed at a time; a phrase ends where its block ends.
BLOCK = 512
CHUNK = 4 << 20

UNKNOWN = "und"
RESULT = "held_out boolean, lang_pred string, score double"

NOT_LETTERS = re.compile(r"[\W\d_]+")
ROOT = 1  # state 0 is none


def normal(text: str) -> bytes:
    """Words of small letters between single spaces; empty if there is no letter."""
    shown = NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {shown} ".encode() if any(map(str.isalpha, shown)) else b""


class Automaton:
    """Recognises every string of ``text``: a transition table by state and symbol, 0 for none."""

    def __init__(self, text: bytes):
        self.bits = math.log2(len(text) + 1)
        seen = np.unique(np.frombuffer(text, np.uint8))
        self.symbol = np.zeros(256, np.int32)  # 0 stands for bytes that the text lacks
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        symbols = len(seen) + 1
        table = np.zeros((2 * len(text) + 2, symbols), np.int32)
        link, length = [0] * len(table), [0] * len(table)
        last = states = ROOT
        for c in self.symbol[np.frombuffer(text, np.uint8)].tolist():
            states += 1
            new, at = states, last
            length[new] = length[last] + 1
            while at and not table[at, c]:
                table[at, c] = new
                at = link[at]
            if not at:
                link[new] = ROOT
            else:
                then = int(table[at, c])
                if length[then] == length[at] + 1:
                    link[new] = then
                else:
                    states += 1
                    twin = states
                    table[twin], link[twin], length[twin] = table[then], link[then], length[at] + 1
                    while at and table[at, c] == then:
                        table[at, c] = twin
                        at = link[at]
                    link[then] = link[new] = twin
            last = new
        # States stand for the place of their row, so that a step is one look-up.
        self.root = ROOT * symbols
        self.next = (table[: states + 1] * symbols).ravel()

    def phrases(self, text: np.ndarray, starts: np.ndarray, active: np.ndarray) -> np.ndarray:
        """The number of phrases of each block of ``text``.

        Blocks begin at ``starts``, the longest first; ``active[k]`` of them are longer than k bytes.
        A byte that the sample lacks is a phrase.
        """
        text = self.symbol[text]
        state = np.full(len(starts), self.root, np.int32)
        found = np.zeros(len(starts), np.int64)
        for k, n in enumerate(active.tolist()):
            symbol, now = text[starts[:n] + k], state[:n]
            then = self.next[now + symbol]
            (ended,) = np.nonzero(then == 0)
            if len(ended):
                found[ended] += now[ended] != self.root
                begun = self.next[self.root + symbol[ended]]
                found[ended] += begun == 0
                then[ended] = np.where(begun == 0, self.root, begun)
            state[:n] = then
        return found + (state != self.root)


@functools.lru_cache(maxsize=1)
def _automata(samples: tuple[tuple[str, bytes], ...]) -> tuple[Automaton, ...]:
    return tuple(Automaton(text) for _, text in samples)


def entropies(texts: Sequence[bytes], samples: tuple[tuple[str, bytes], ...]) -> np.ndarray:
    """Bits a byte of each normalised text (none is empty) by each language's sample."""
    sizes = np.array([len(text) for text in texts])
    blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = (np.cumsum(sizes) - sizes)[owner] + place * BLOCK
    lengths = np.minimum(sizes[owner] - place * BLOCK, BLOCK)
    longest_first = np.argsort(-lengths, kind="stable")
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(lengths.max()), side="right")
    joined = np.frombuffer(b"".join(texts), np.uint8)
    out = np.empty((len(texts), len(samples)))
    for k, automaton in enumerate(_automata(samples)):
        found = automaton.phrases(joined, starts[longest_first], active)
        phrases = np.bincount(owner[longest_first], found, len(texts))
        out[:, k] = phrases * automaton.bits / sizes
    return out


def verdicts(texts: Sequence[bytes], samples: tuple[tuple[str, bytes], ...]) -> list[tuple[str, float]]:
    """Language and score of normalised texts: how far the best stays below the second, 0 to 1."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    known = [k for k, text in enumerate(texts) if text]
    if not known or not samples:
        return out
    bits = entropies([texts[k] for k in known], samples)
    best = bits.argmin(axis=1)  # of equal ones the first by name
    if len(samples) > 1:
        least = np.partition(bits, 1, axis=1)
        scores = 1 - least[:, 0] / least[:, 1]
    else:
        scores = np.ones(len(known))
    for k, language, score in zip(known, best.tolist(), scores.tolist()):
        out[k] = (samples[language][0], score)
    return out


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Normalised texts of a batch, of about ``CHUNK`` bytes or one text, with their first row."""
    start, held, texts = 0, 0, []
    for k, text in enumerate(batch.column("text")):
        texts.append(normal(text.as_py() or ""))
        held += len(texts[-1])
        if held >= CHUNK:
            yield start, texts
            start, held, texts = k + 1, 0, []
    if texts:
        yield start, texts


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; one without an id is not."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def samples_of(docs: DataFrame, sample: int = SAMPLE) -> tuple[tuple[str, bytes], ...]:
    """Labelled text by language: at most ``sample / number of languages`` characters of each.

    Distinct texts are drawn by a hash of the text, whichever source or order they come in. Only the
    drawn pieces reach the driver, expected ``SPARE`` times what is kept, and one row per language.
    """
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & (F.col("text") != "") & ~held_out(F.col("doc_id")))
    drawn = F.xxhash64(F.lit(12), F.col("text"))
    size = F.least(F.length("text"), F.lit(PIECE)).cast("long")
    sizes = rows.select("lang", drawn.alias("drawn"), size.alias("size")).distinct()
    sizes = {row["lang"]: row["size"] for row in sizes.groupBy("lang").agg(F.sum("size").alias("size")).collect()}
    if not sizes:
        return ()
    quota = max(sample // len(sizes), 1)
    # The hash is spread evenly over all longs, so this share of them draws this share of the texts.
    limits = [
        (lang, min(SPARE * max(quota, PIECE) * 2**64 // size, 2**64 - 1) - 2**63)
        for lang, size in sizes.items()
    ]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, _limit long")
    pieces = (
        rows.withColumn("drawn", drawn)
        .join(F.broadcast(limits), "lang")
        .filter(F.col("drawn") <= F.col("_limit"))
        .select("lang", "drawn", F.substring("text", 1, PIECE).alias("piece"))
        .distinct()
        .collect()
    )
    held: dict[str, bytes] = {}
    for row in sorted(pieces, key=lambda row: (row["lang"], row["drawn"], row["piece"])):
        text = held.get(row["lang"], b"")
        if len(text) < quota:
            held[row["lang"]] = text + normal(row["piece"])[: quota - len(text)]
    return tuple((lang, text) for lang, text in sorted(held.items()) if text)


def identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of each document.

    Languages are learnt from text and non-null ``lang`` of documents that are not held out; equal
    texts count once. A prediction reads the text alone, all of it. A null text, one without a letter,
    and any text where nothing was learnt are ``und`` with score 0. Equally good languages go to the
    first by name; with one language the score is 1. Repeated rows are answered each, other columns are
    not read. Workers hold tables of about 170 bytes per character of the sample of all languages,
    which is bounded, and one text at a time if it is long.
    """
    samples = samples_of(docs, sample)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _chunks(batch):
                rows = batch.slice(start, len(texts))
                names, scores = zip(*verdicts(texts, samples))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(predicted, f"doc_id {kind}, {RESULT}")
