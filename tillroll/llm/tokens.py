"""Token ids of texts by a public tokenizer, each distinct piece of text encoded once per worker.

Both kinds of vocabulary split a text before they merge, and never merge across the cuts made here,
so the ids of a text are the ids of its pieces one after the other. A word of plain letters goes to
the tokenizer's merge step at once, anything else through all of its steps. Up to ``MOST`` pieces
are remembered: half of them since the last half was full, and that half, of which a piece met again is
taken over. A worker outlives its tasks and runs those of other operators, too, so it forgets the
pieces when it has encoded nothing for ``IDLE`` seconds.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import threading
import time
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST = 600_000
IDLE = 3
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a Spark task has one core


class Pieces(dict):
    """The ids of pieces as bytes of ``dtype``: remembered, or encoded when they are missing."""

    # Letters, then up to four other signs, which the vocabularies split off; an apostrophe is not
    # among them, as it may begin a suffix.
    MARKS = ".,;:!?#*$%&|"
    PLAIN = re.compile(f"([{LETTERS}]+)([{MARKS}]{{0,4}})")

    def __init__(self, tokenizer, before: str = "", lower: bool = False):
        from tokenizers import pre_tokenizers

        self.tokenizer = tokenizer
        self.vocabulary_size = 1 + max(tokenizer.get_vocab(with_added_tokens=True).values())
        self.dtype = np.dtype("<u2" if self.vocabulary_size <= 1 << 16 else "<u4")
        self.earlier: dict[str, bytes] = {}
        self.merge = self.tokenizer.model.tokenize
        self.before, self.lower = before, lower
        bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.marks: dict[str, bytes] = {}  # bounded: four signs of eleven
        letters = (chr(c) for c in (0x20, *range(0x41, 0x100)))
        self.written = {ord(c): bytes_of(c)[0][0] for c in letters}
        self.start = before.translate(self.written)
        self.used = time.monotonic()
        threading.Thread(target=self.forget_when_idle, daemon=True).start()

    def forget_when_idle(self) -> None:
        # A task may go on meanwhile: it looks up a missing piece again.
        while True:
            time.sleep(IDLE)
            if self and time.monotonic() - self.used > IDLE:
                self.clear()
                self.earlier = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def word(self, letters: str) -> bytes:
        if self.lower:
            letters = letters.lower()
        shown = self.start + (letters if letters.isascii() else letters.translate(self.written))
        return array(self.code, [token.id for token in self.merge(shown)]).tobytes()

    def mark(self, signs: str) -> bytes:
        if signs not in self.marks:
            self.marks[signs] = self.whole(signs)
        return self.marks[signs]

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MOST // 2:
            self.earlier = self.copy()
            self.clear()
        if (known := self.earlier.get(piece)) is not None:
            self[piece] = known
            return known
        if piece.isascii() and piece.isalpha():
            found = self.word(piece)
        elif not (plain := self.PLAIN.fullmatch(piece)):
            found = self.whole(self.before + piece) if piece or self.before else b""
        elif mark := plain[2]:
            found = self[plain[1]] + self.mark(mark)
        else:
            found = self.word(piece)
        self[piece] = found
        return found


def loaded(path: str):
    """The tokenizer of a file, for several kinds of pieces."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    tokenizer.model._resize_cache(0)  # the ids of pieces are remembered here
    return tokenizer


class LowerWords:
    """A vocabulary that drops white space and case: pieces stand between spaces and line feeds.

    A piece is looked up once for all texts of a call, however often they hold it, and its ids are
    copied to each of its places by Arrow. Of a word with signs behind it the word alone is remembered.
    """

    def __init__(self, path: str):
        self.pieces = Pieces(loaded(path), lower=True)
        self.dtype = self.pieces.dtype

    def known(self, pieces: pa.Array) -> pa.Array:
        """The ids of distinct pieces as bytes, each word looked up once whatever signs stand behind it."""
        words = pc.utf8_rtrim(pieces, Pieces.MARKS)
        signs = pc.subtract(pc.binary_length(pieces), pc.binary_length(words))
        ends = pc.match_substring_regex(words, f"[{LETTERS}]$")
        cut = pc.and_(ends, pc.and_(pc.greater(signs, 0), pc.less_equal(signs, 4)))
        held = pc.if_else(cut, words, pieces).dictionary_encode()
        distinct = held.dictionary.to_numpy(zero_copy_only=False)
        found = pa.array(map(self.pieces.__getitem__, distinct), pa.large_binary()).take(held.indices)
        nothing = pa.scalar(b"", pa.large_binary())
        for count in range(1, 5):
            these = pc.and_(cut, pc.equal(signs, count))
            marks = pc.utf8_slice_codeunits(pieces.filter(these), -count).dictionary_encode()
            behind = pa.array(map(self.pieces.mark, marks.dictionary.to_pylist()), pa.large_binary())
            whole = pc.binary_join_element_wise(found.filter(these), behind.take(marks.indices), nothing)
            found = pc.replace_with_mask(found, these, whole)
        return found

    def encode(self, texts: Iterable[str] | pa.Array) -> list[bytes]:
        self.pieces.used = time.monotonic()
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        spaced = pc.replace_substring(column.cast(pa.large_string()), "\n", " ")
        pieces = pc.split_pattern(spaced, " ")
        held = pieces.flatten().dictionary_encode()
        ids = self.known(held.dictionary).take(held.indices)
        # Where each text's pieces begin and end among all pieces, and so its bytes among all bytes.
        places = np.concatenate([[0], np.cumsum(pc.list_value_length(pieces).to_numpy(), dtype=np.int64)])
        sizes = pc.binary_length(ids).to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[places].tolist()
        whole = memoryview(ids.buffers()[2] or b"")
        return [bytes(whole[s:e]) for s, e in itertools.pairwise(ends)]


class ByteLevel:
    """A byte-level vocabulary whose pieces begin with the space before a word.

    A run of white space is split in a way that depends on what follows it, so a text that has one
    is encoded whole. A single line feed stands for itself.
    """

    RUN = re.compile(r"\s\s")

    def __init__(self, path: str):
        tokenizer = loaded(path)
        self.first, self.later = Pieces(tokenizer), Pieces(tokenizer, before=" ")
        self.dtype = self.first.dtype

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        feed, first, later = self.first.whole("\n"), self.first, self.later.__getitem__
        first.used = self.later.used = time.monotonic()
        out = []
        for text in texts:
            if self.RUN.search(text):
                out.append(first.whole(text))
                continue
            lines = []
            for line in text.split("\n"):
                start, *rest = line.split(" ")
                lines.append(b"".join([first[start], *map(later, rest)]))
            out.append(feed.join(lines))
        return out

    @functools.cached_property
    def sentence_marks(self) -> tuple[np.ndarray, np.ndarray]:
        """For each id whether it may end a sentence, and whether it may follow one."""
        vocabulary = self.first.tokenizer.get_vocab(with_added_tokens=True)
        ends = np.zeros(self.first.vocabulary_size, bool)
        opens = np.zeros_like(ends)
        for token, number in vocabulary.items():
            ends[number] = token[-1:] in (".", "!", "?", "Ċ")  # the last is a line feed
            opens[number] = token[:1] in ("Ġ", "Ċ")  # a space, a line feed
        return ends, opens


@functools.lru_cache(maxsize=2)
def lower_words(path: str) -> LowerWords:
    return LowerWords(path)


@functools.lru_cache(maxsize=2)
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)
