"""Words of a vocabulary without white space, and ranks in bytes."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa

from tillroll.llm.binary import decode_ranks, encode_ranks
from tillroll.llm.common import row_chunks
from tillroll.llm.tokens import LowerWords, loaded


def test_a_word_is_encoded_once_whatever_signs_stand_behind_it():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = loaded(path)
    own = LowerWords(path)
    texts = ["corpus, corpus. corpus; corpus?! corpus", "corpus\ncorpus: über, über.", "", "corpus|"]
    assert [np.frombuffer(ids, own.dtype).tolist() for ids in own.encode(texts)] == [
        whole.encode(text, add_special_tokens=False).ids for text in texts
    ]
    assert set(own.pieces) == {"corpus", "über", ""}


def test_signs_are_cut_off_words_only_where_the_vocabulary_cuts():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = loaded(path)
    texts = ['a"). b) c"., it\'s, x\'. 4. 4,. d..... e,.;: ,. f,g. é. ẞ, ́. ḯ; ª. 日本.', "h\tk.\t l.", "m. n.", "'s.", "#*$%&| o#*$%"]
    for ids, text in zip(LowerWords(path).encode(texts), texts, strict=True):
        assert np.frombuffer(ids, np.uint16).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_ranks_of_every_width_come_back():
    for most in (0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1):
        for n in (1, 2, 3, 4, 5, 1000):
            ranks = np.linspace(0, most, n).astype(np.uint32)
            assert (decode_ranks(*encode_ranks(ranks), n) == ranks).all()
    assert encode_ranks(np.zeros(0, np.uint32)) == (b"", b"")


def test_chunks_of_rows_are_whole_and_bounded():
    texts = ["abc", None, "", "x" * 50, "de", "f" * 9, None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    chunks = [chunk.column("text").to_pylist() for chunk in row_chunks(batch, 10)]
    assert [text for chunk in chunks for text in chunk] == texts
    assert all(len(chunk) == 1 or sum(len(text or "") for text in chunk) <= 10 for chunk in chunks)
    assert not list(row_chunks(batch.slice(0, 0), 10))
