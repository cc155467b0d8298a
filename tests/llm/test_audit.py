"""The filter audit against brute force, on texts around every limit."""

import itertools
import random
import re
from collections import Counter, defaultdict

import pytest

from tillroll.llm import audit

DOCS = "doc_id long, text string, source string, part string, mask string, digest string, first long"
LABELS = "doc_id long, quality int, toxic int, part string, _good string"


def failed(text, copied):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    capitals = re.findall("[A-Z]", text)
    tests = {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(capitals) > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": copied,
    }
    return {letter for letter, fails in tests.items() if fails}


def expected(rows, labels):
    texts = defaultdict(list)
    for doc_id, text, _ in rows:
        if doc_id is not None:
            texts[text or ""].append(doc_id)
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    out = Counter()
    orders = ["".join(order) for order in itertools.permutations("ABCDE")]
    for doc_id, text, source in rows:
        text, part = text or "", source or ""
        fails = failed(text, doc_id is not None and min(texts[text]) < doc_id)
        for order in orders:
            for k, letter in enumerate(order):
                earlier = fails & set(order[:k])
                at = (part, order, k + 1)
                out[at, "kept"] += not fails & set(order[: k + 1])
                out[at, "removed"] += letter in fails and not earlier
                out[at, "redundant"] += letter in fails and bool(earlier)
                out[at, "unique_fails"] += fails == {letter}
                out[at, "good_lost"] += letter in fails and not earlier and doc_id in good
                out[at, "toxic_lost"] += letter in fails and not earlier and doc_id in toxic
    steps = [(part, order, k) for part in {source or "" for *_, source in rows} for order in orders for k in range(1, 6)]
    shapley = Counter()
    for part, order, k in steps:
        shapley[part, order[k - 1]] += out[(part, order, k), "removed"]
    return {at: (*(out[at, name] for name in audit.COUNTS[:-1]), shapley[at[0], at[1][at[2] - 1]]) for at in steps}


def made_rows():
    draw = random.Random(5)
    texts = [
        None,
        "",
        " \n\t\x0b ",
        " ".join(f"w{i}" for i in range(199)),
        " ".join(f"w{i}" for i in range(200)),
        " ".join(f"w{i % 100}" for i in range(200)),
        " ".join(f"w{i % 99}" for i in range(200)),
        "A" + "é" * 49,
        "A" + "é" * 48,
        " ".join(f"W{i}" for i in range(300)),
        "a # b",
        " ".join("$" for _ in range(300)),
        "no-break space   is part of a word",
        "long " * 30_000,
    ]
    rows = [(i, draw.choice(texts), draw.choice(["s", "t", "", None])) for i in range(150)]
    rows += [(7, texts[3], "s"), (7, texts[3], "s"), (None, texts[4], "t"), (None, texts[4], None)]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1])) for i in range(0, 150, 2)]
    return rows, labels + [(7, 1, 1), (7, 0, 0), (None, 1, 1), (4000, 1, 1)]


def frames(spark, rows, labels):
    docs = [(i, text, source, "clash", "clash", "clash", 1) for i, text, source in rows]
    marks = [(i, quality, toxic, "clash", "clash") for i, quality, toxic in labels]
    return spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(marks, LABELS)


def test_counts_equal_brute_force(spark):
    rows, labels = made_rows()
    found = audit.interactions(*frames(spark, rows, labels))
    assert found.columns == ["part", "filter_order", "step", *audit.COUNTS]
    assert {tuple(row[:3]): tuple(row[3:]) for row in found.collect()} == expected(rows, labels)


def test_empty_tables(spark):
    rows, labels = made_rows()
    docs, marks = frames(spark, rows, labels)
    assert audit.interactions(docs.limit(0), marks).isEmpty()
    unlabelled = audit.interactions(docs, marks.limit(0)).collect()
    assert {tuple(row[:3]): tuple(row[3:]) for row in unlabelled} == expected(rows, [])


@pytest.mark.parametrize("n", [1, 2**31, 2**62])
def test_fields_of_a_sum_never_meet(n):
    wide = sum(audit.outcomes(mask) * n for mask in (0, 31))
    fields = audit.unpacked(wide)
    first = list(audit.ORDERS).index("ABCDE")
    assert fields[first, 0].tolist() == [n, n, 0, 0]
    assert fields[first, 4].tolist() == [n, 0, n, 0]
    assert fields.max() == n
