"""Pieces put together again, their padding, and blocks that do not follow the batches."""

from __future__ import annotations

from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tillroll.llm import packing
from tillroll.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_make_up_their_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    pieces, windows = defaultdict(list), defaultdict(int)
    for r in packing.packed(docs, PATH, 1).collect():
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]] += r["length"]
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert pieces.keys() == texts.keys()
    assert max(map(len, pieces.values())) > 2  # some are split
    for name, text in texts.items():
        want = np.array([*plain.encode(text, add_special_tokens=False).ids, 1], "<u4")
        held, start = [], 0
        for r in sorted(pieces[name], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], len(r["ids"])) == (start, len(want), 4 * r["length"])
            start += r["length"]
            held.append(bytes(r["ids"]))
        assert b"".join(held) == want.tobytes()
    padded = sum(2048 - n for n in windows.values())
    assert padded < 0.03 * 2048 * len(windows)


def test_blocks_do_not_follow_batches(monkeypatch):
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 3000)
    texts = [" ".join(f"w{i * k}" for i in range(5 + 37 * k % 211)) for k in range(120)]
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(120)), "text": texts})

    def made(size: int) -> list[dict]:
        batches = (rows.slice(i, size) for i in range(0, 120, size))
        return [r for out in packing._packed(PATH, 1)(batches) for r in out.to_pylist()]

    whole = made(120)
    assert len({r["sequence_id"] for r in whole}) > 8
    assert made(1) == made(7) == whole
