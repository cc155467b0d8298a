"""Operators of the training-data subpackage against brute force, on small tables with odd rows."""

from __future__ import annotations

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import (
    binary,
    chat,
    decontaminate,
    neardup,
    packing,
    quality,
    scoring,
    sharding,
    suffixes,
    urls,
)
from tillroll.llm import tokens
from tillroll.llm.oracles import ORACLES
from tillroll.llm.queries import QUERIES
from tillroll.llm.tokens import ByteLevel, LowerWords

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"
SF = "/root/testdata/sf0.001"


def words(n: int, salt: int = 0) -> list[str]:
    return [f"w{(i * 7919 + salt * 104729) % 100003}" for i in range(n)]


LONG = " ".join(words(300, 1))
NEAR = " ".join([*words(295, 1), "changed", "words", "at", "the", "end"])
ROWS = [
    (1, LONG),
    (2, NEAR),
    (3, LONG),
    (3, LONG),  # a repeated row
    (4, None),
    (5, ""),
    (6, "  \n\t "),
    (7, "two words"),
    (8, "TWO words"),
    (9, "é" * 400),
    (10, "a" * 500),
    (None, " ".join(words(80, 5))),
    (11, " ".join(words(6000, 9))),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "h" if i != 5 else None, len(t or ""), "clash") for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("doc_id < -1")


def test_sharding_fills_shards_evenly_without_gaps(docs, none):
    rows = sharding.shard_documents(docs, 5).collect()
    assert len(rows) == len(ROWS)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(none).count() == 0


@pytest.mark.parametrize("slack", [0.0, 0.1, 0.5])
def test_place_puts_a_row_at_the_first_shard_with_room(slack):
    counts = {c: (c * 31) % 7 for c in range(0, 64, 3)}
    nodes = sharding.ring(4, 3, 64)
    room, want = sharding.capacities(sum(counts.values()), 4, slack), {}
    used = [0] * 4
    waiting = {c: (sum(spot < c for spot, _ in nodes), list(range(counts[c]))) for c in sorted(counts)}
    while waiting:
        left = {}
        for c, (at, ranks) in waiting.items():
            at = next(i % len(nodes) for i in range(at, at + len(nodes)) if room[nodes[i % len(nodes)][1]])
            shard = nodes[at][1]
            for k in list(ranks):
                if room[shard]:
                    want[c, k] = (shard, used[shard])
                    room[shard], used[shard] = room[shard] - 1, used[shard] + 1
                    ranks.remove(k)
            if ranks:
                left[c] = (at + 1, ranks)
        waiting = left
    got = {}
    for c, start, end, shard, slot in sharding.place(counts, 4, 3, 64, slack):
        got.update({(c, k): (shard, slot + k - start) for k in range(start, end)})
    assert got == want


def test_sizes_and_checksums_of_documents(docs):
    for r in sharding.shard_documents(docs, 5).collect():
        texts = {(t or "").encode() for i, t in ROWS if i == r["doc_id"]}
        assert (r["size"], r["text_crc32"]) in {(len(t) + 16, zlib.crc32(t)) for t in texts}
        assert r["law"] == "rows" and r["grown_shard"] is None


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_near_duplicates_equal_brute_force(docs, none):
    sets = [(i, shingles(t)) for i, t in ROWS]
    ids = [i for i, _ in sets]
    label = {k: k for k in range(len(sets))}
    for _ in sets:
        for a, (_, x) in enumerate(sets):
            for b, (_, y) in enumerate(sets):
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    want = Counter()
    for k, (i, s) in enumerate(sets):
        group = [ids[j] for j in label if label[j] == label[k] and ids[j] is not None]
        want[i, len(s), min(group) if s and group else i] += 1
    got = neardup.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert neardup.near_duplicates(none).count() == 0


def test_many_near_copies_are_one_component(spark):
    base = words(200, 3)
    rows = []
    for i in range(60):
        copy = list(base)
        copy[(i * 3) % 200] = f"x{i}"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, " ".join(words(150, 50 + i))) for i in range(20)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got if r["doc_id"] < 60} == {0}
    assert all(r["kept"] for r in got if r["doc_id"] >= 100)


def test_copies_around_the_limit_equal_brute_force(spark, monkeypatch):
    """Many blocks of copies of one text, most pairs of which lie just below the limit."""
    monkeypatch.setattr(neardup, "BLOCK_SETS", 16)
    base = words(150, 3)
    draw = random.Random(5)
    rows = []
    for i in range(140):
        copy = list(base)
        for at in draw.sample(range(150), draw.choice([2, 3, 4])):
            copy[at] = f"x{draw.randrange(40)}"
        rows.append((i, " ".join(copy)))
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(sets)))
    links = 0
    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if 100 * len(x & y) >= 75 * len(x | y):
                links += 1
                low, high = sorted((label[a], label[b]))
                label = [low if k == high else k for k in label]
    assert 0 < links < len(sets) ** 2 / 4 and len(set(label)) > 5
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(label))


def marked(texts):
    """For each text its bytes and a flag for each that is removed."""
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(b[i : i + 100])
        out.append((b, bytes(gone)))
    return out


def removed(texts):
    return [bytes(x for x, g in zip(b, gone, strict=True) if not g) for b, gone in marked(texts)]


def gone_of(rows):
    return dict(zip((i for i, _ in rows), (gone for _, gone in marked(t for _, t in rows)), strict=True))


def spans(gone):
    return len([run for run in gone.split(b"\0") if run])


def test_repeated_bytes_equal_brute_force(spark, docs, none):
    passage = " ".join(words(40, 77))
    extra = [(20 + i, f"{' '.join(words(30, i))} {passage} {'z' * i}{' '.join(words(9, 99 + i))}") for i in range(8)]
    rows = [*dict.fromkeys(r for r in ROWS if r[0] is not None), *extra]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = dict(zip((i for i, _ in rows), removed(t for _, t in rows), strict=True))
    gone = gone_of(rows)
    for r in suffixes.repeats_removed(table).collect():
        kept = (dict(rows)[r["doc_id"]] or "").encode() if r["kept"] is None else bytes(r["kept"])
        assert kept == want[r["doc_id"]], r["doc_id"]
        assert r["n_removed"] == r["n_bytes"] - len(kept)
        assert r["n_spans"] == spans(gone[r["doc_id"]])
        if r["kept"] is None:
            assert r["sha"] == hashlib.sha256(kept).hexdigest()
    assert suffixes.repeats_removed(none).count() == 0
    assert suffixes.repeats_removed(docs).count() == len(dict.fromkeys(ROWS))
    twice = {r["doc_id"]: r["n_removed"] for r in suffixes.repeats_removed(table.unionAll(table)).collect()}
    assert twice == {i: len(t) - len(want[i]) for i, t in ((i, (t or "").encode()) for i, t in rows)}


def test_intervals_split_by_common_prefix():
    symbols = np.full((3, suffixes.REACH), 7)
    symbols[2, 5] = 8
    out = suffixes.refined(np.zeros(3, int), symbols)
    assert (out[5] == out[5][0]).all()
    assert out[6][0] == out[6][1] >= 0 and out[6][2] == -1


def test_containment_equals_brute_force(spark, docs, none):
    items = [(1, " ".join(words(30, 1))), (2, "two WORDS"), (3, None), (4, " ".join(words(40, 555)))]
    items.append((5, " ".join(words(6000, 9)[2000:2040])))
    table = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, t in ROWS:
        for j, u in items:
            s = shingles(u)
            if s and 100 * len(s & shingles(t)) >= 75 * len(s):
                want.add((i, j, len(s), len(s & shingles(t))))
    got = decontaminate.contaminated(docs, table).collect()
    assert {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in got} == want
    assert decontaminate.contaminated(none, table).count() == 0
    assert decontaminate.contaminated(docs, table.limit(0)).count() == 0


HARD = ["", " ", "a  b", "a \nb", "a\n b", "x\n\n\ny  ", " lead", "tail ", "don't 'S 12,5", "a b 　c",
        "<|endoftext|> x", "\x1c a\x1fb", "ÀÉ ΣΑΣ İ", "é ́x", "\t tab", "a\r\n b", "日本 🙂"]


@pytest.mark.parametrize("kind, name", [(ByteLevel, "byte_bpe_50k.json"), (LowerWords, "word_bpe_49k.json")])
def test_pieces_give_the_ids_of_whole_texts(kind, name):
    made = kind(public_tokenizers.path(name))
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    plain.encode_special_tokens = True
    for text, ids in zip(HARD, made.encode(HARD), strict=True):
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, made.dtype).tolist() == want, repr(text)


def test_idle_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr(tokens, "IDLE", 0.05)
    coder = ByteLevel(public_tokenizers.path("byte_bpe_50k.json"))
    before = coder.encode(["One text, and more words."])
    assert coder.later
    for _ in range(100):
        time.sleep(0.05)
        if not coder.first and not coder.later:
            break
    assert not coder.first and not coder.later
    assert coder.encode(["One text, and more words."]) == before


def test_few_remembered_pieces_give_the_same_ids(monkeypatch):
    texts = [" ".join(words(60, k % 7)) + ", the end. Of it" for k in range(30)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = ByteLevel(path).encode(texts)
    monkeypatch.setattr(tokens, "MOST", 50)
    coder = ByteLevel(path)
    assert coder.encode(texts) == want
    assert max(len(p) + len(p.earlier) for p in (coder.first, coder.later)) <= 52


def test_rank_bytes_round_trip():
    ranks = np.array([0, 255, 256, 65535, 65536, 1 << 24, 7] * 3, np.uint32)
    assert (binary.decode_ranks(*binary.encode_ranks(ranks), len(ranks)) == ranks).all()
    assert len(binary.decode_ranks(*binary.encode_ranks(ranks[:0]), 0)) == 0


def test_token_files_read_back(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    got = binary.round_trip(docs, path, 2).collect()
    start, order = 0, sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    for r, (i, t) in zip(sorted(got, key=lambda r: (r["start"])), order, strict=True):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(ids))
        start += len(ids)
    assert binary.round_trip(none, path, 2).count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(4)
    for _ in range(30):
        places = np.unique(np.concatenate([np.arange(10, 200, 15), rng.integers(1, 200, 12), [200]]))
        penalties = rng.integers(0, 9, len(places))
        best = {0: 0}
        for p, pen in zip(places.tolist(), penalties.tolist(), strict=True):
            best[p] = min(v + 40 - (p - q) + pen for q, v in best.items() if p - q <= 40)
        cuts = packing.best_cuts(places, penalties, 40)
        pen = dict(zip(places.tolist(), penalties.tolist(), strict=True))
        steps = np.diff([0, *cuts])
        assert steps.max() <= 40 and sum(40 - steps) + sum(pen[c] for c in cuts) == best[200]


def test_packing_holds_every_id_once(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    rows = packing.packed(docs, path, 1).collect()
    want = Counter(tuple([*plain.encode(t or "", add_special_tokens=False).ids, 1]) for _, t in ROWS)
    by_window = defaultdict(list)
    for r in rows:
        by_window[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_window.values():
        ends = np.cumsum([n for _, n in sorted(spans)])
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert sum(r["length"] for r in rows) == sum(len(k) * n for k, n in want.items())
    whole = [r for r in rows if r["length"] == r["doc_tokens"]]
    assert all(tuple(np.frombuffer(r["ids"], "<u4").tolist()) in want for r in whole)
    assert packing.packed(none, path, 1).count() == 0


def test_scores_of_odd_rows(docs, none):
    rows = scoring.scored(docs).collect()
    assert len(rows) == len(ROWS) and all(r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (4, 5, 6)} == {1}
    assert scoring.scored(none).count() == 0


def test_quality_removes_frequent_lines_but_not_their_first(spark):
    common = " ".join(words(30, 1))
    rows = [(i, f"{common}\n{' '.join(words(80, 10 + i))}", "h") for i in range(6)]
    rows += [(10 + i, f"{common}\n{' '.join(words(25, 40 + i))}", "h") for i in range(2)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    frequent = quality.frequent_lines(table, line_docs=3)
    places = {r["_doc"]: r["_places"] for r in quality.removed_lines(table, frequent).collect()}
    assert places == {i: [0] for i, _, _ in rows if i}


def test_quality_of_odd_rows(docs, none):
    rows = quality.judged(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r["kept"] for r in rows if r["doc_id"] in (4, 5, 6, 7)} == {False}
    assert quality.judged(none).count() == 0


def test_chat_comes_back_whatever_it_says(spark):
    said = [r"\### Assistant: </turn> ok", "</turn>", "### user: x", r"\l \\h b\b", "", None, "a: b\n", "#", "<"]
    rows = [(1, k, "assistant" if k % 2 else "us: er#", t, "clash") for k, t in enumerate(said)]
    rows += [(None, 0, None, "x", "y"), (2, 0, "assistant", "same", "y"), (2, 0, "assistant", "same", "y")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")
    back = chat.read_back(chat.formatted(table)).orderBy("conv_id", "part").collect()
    one = [r for r in back if r["conv_id"] == 1]
    assert [r["text"] for r in one] == [t or "" for t in said]
    assert [r["role"] for r in one] == ["assistant" if k % 2 else "us: er#" for k in range(len(said))]
    assert [r["loss"] for r in one] == [(t or "") if k % 2 else "" for k, t in enumerate(said)]
    assert len(back) == len(rows)
    assert chat.digests(chat.read_back(chat.formatted(table.limit(0)))).count() == 0


def test_lists_apply_at_fetch_time(spark):
    day = "DATE '2024-01-{:02d}'"
    entries = spark.sql(
        " UNION ALL ".join(
            f"SELECT '{p}' AS pattern, {day.format(d)} AS day, '{a}' AS action"
            for p, d, a in [("x.org", 5, "block"), ("x.org", 10, "allow"), ("a.x.org", 7, "block"), ("x.org", 5, "allow")]
        )
    )
    asked = [("http://x.org/p", 4), ("http://x.org/p", 5), ("http://x.org/p", 10), ("https://a.x.org/", 12), ("http://y.org", 9)]
    captures = spark.sql(" UNION ALL ".join(f"SELECT '{u}' AS url, {day.format(d)} AS day, 1 AS kept" for u, d in asked))
    captures = captures.unionAll(captures).unionAll(spark.sql(f"SELECT null, {day.format(3)}, 1"))
    got = Counter((r["url"], r["day"].day, r["action"]) for r in urls.filtered(captures, entries).collect())
    verdicts = ["allow", "block", "allow", "block", "allow"]
    assert got == Counter({(u, d, v): 2 for (u, d), v in zip(asked, verdicts, strict=True)} | {(None, 3, "allow"): 1})
    assert urls.filtered(captures.limit(0), entries).count() == 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, found)) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = f"SELECT doc_id, text FROM documents JOIN ({ORACLES['op5_line_frequency']}) USING (doc_id)"
    left = dict(con.execute(f"{sql} WHERE kept ORDER BY doc_id").fetchall())  # no frequent lines here
    sets, alone = {i: shingles(t) for i, t in left.items()}, {}
    label = {i: i for i in left}
    for _ in range(3):
        for a, x in sets.items():
            for b, y in sets.items():
                if 100 * len(x & y) >= 75 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    alone = {i: t for i, t in left.items() if label[i] == i}
    cut = dict(zip(alone, (b.decode(errors="ignore") for b in removed(alone.values())), strict=True))
    items = [shingles(t) for (t,) in con.execute(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    clean = {
        i: t for i, t in cut.items()
        if t and not any(100 * len(s & shingles(t)) >= 75 * len(s) for s in items)
    }
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(plain.encode(t, add_special_tokens=False).ids) + 1 for i, t in clean.items()}
    rows = corpus_pipeline.run(spark, SF)
    got = rows.groupBy("doc_id").agg(F.max("doc_tokens"), F.sum("length")).collect()
    assert {r[0]: r[1] for r in got} == want
    assert {r[0]: r[2] for r in got} == want
