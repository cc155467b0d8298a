"""Whole conversations read back by the grammar, against a parser in plain Python."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from tillroll.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = ["### ", "##", "# ", "</turn>", "</turn>\n", "</", "turn>", "\n", ": ", ":", "\\", "\\b", "\\h", "\\l", "\\c",
        "assistant", "### user: ", "x", " ", "é🙂", "### assistant: a</turn>\n"]


def unescaped(text: str) -> str:
    for form, plain in (("\\c", ":"), ("\\l", "<"), ("\\h", "#"), ("\\b", "\\")):
        text = text.replace(form, plain)
    return text


def parsed(whole: str) -> list[tuple[str, str]]:
    turns, at = [], 0
    turn = re.compile(r"### (.*?): (.*?)</turn>\n", re.DOTALL)
    while at < len(whole):
        met = turn.match(whole, at)
        assert met, whole[at : at + 80]
        role, text = met.groups()
        text = text.replace("\\l", "<").replace("\\h", "#").replace("\\b", "\\")
        turns.append((unescaped(role), text))
        at = met.end()
    return turns


def said(seed: int) -> list[tuple[int, int, str, str]]:
    rng = random.Random(seed)
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "".join(rng.choices(BITS, k=rng.randint(0, 3)))])
            rows.append((conv, turn, role, "".join(rng.choices(BITS, k=rng.randint(0, 7)))))
    return rows


def test_joined_conversations_parse_to_their_source(spark):
    rows = said(5)
    output = chat.formatted(spark.createDataFrame(rows, SCHEMA).repartition(3))
    whole: dict[int, list[str]] = {}
    for r in output.orderBy("conv_id", "part").collect():
        whole.setdefault(r["conv_id"], []).append(r["segment"])
    source = {c: [(role, text) for conv, _, role, text in rows if conv == c] for c, *_ in rows}
    assert {c: parsed("".join(segments)) for c, segments in whole.items()} == source

    back: dict[int, list[tuple[str, str, str]]] = {}
    for r in chat.read_back(output).orderBy("conv_id", "part").collect():
        back.setdefault(r["conv_id"], []).append((r["role"], r["text"], r["loss"]))
    assert back == {c: [(a, t, t if a == "assistant" else "") for a, t in turns] for c, turns in source.items()}

    for r in chat.digests(chat.read_back(output)).collect():
        turns, segments = source[r["conv_id"]], "".join(whole[r["conv_id"]])
        loss = "".join(text for role, text in turns if role == "assistant")
        told = "".join(f"{role}\n{text}\n" for role, text in turns)
        assert (r["n_turns"], r["formatted_chars"], r["loss_chars"]) == (len(turns), len(segments), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_a_wrong_border_shows(spark):
    """Turns come from the text, not from the rows: a closing left unescaped makes two turns of one."""
    output = chat.formatted(spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b")], SCHEMA))
    spoilt = F.replace("segment", F.lit(": a"), F.lit(": a</turn>\n### user: c"))
    turns = chat.read_back(output.withColumn("segment", spoilt)).orderBy("part").collect()
    assert [r["text"] for r in turns] == ["a", "c", "b"]
    cut = chat.read_back(output.withColumn("segment", F.replace("segment", F.lit("a</turn>\n"), F.lit("a"))))
    assert cut.count() == 1


def test_a_long_conversation(spark):
    turns = spark.range(3000).select(
        F.lit(None).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("</turn>\n### "), F.col("id").cast("string")).alias("text"),
    )
    (r,) = chat.digests(chat.read_back(chat.formatted(turns))).collect()
    loss = "".join(f"</turn>\n### {i}" for i in range(1, 3000, 2))
    assert r["n_turns"] == 3000 and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
