"""Quality rules of single documents, and line frequency across documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import SPACE_PATTERN, SPACES, let, same, shielded, words

MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
LINE_DOCS = 5  # distinct texts of a host, however many the host has
LEAST_LEFT = 0.2

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "kept",
    "n_removed_words",
)


def _repeated_words(tokens: Column) -> Column:
    """How many words stand in a window of three that is found twice or more."""
    windows = F.when(
        F.size(tokens) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(tokens) - 3),
            lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def starts(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return let(
            F.sort_array(placed),
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        F.transform(
                            s,
                            lambda x, k: F.struct(
                                x["i"].alias("i"),
                                (
                                    F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                                    | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
                                ).alias("twice"),
                            ),
                        ),
                        lambda x: x["twice"],
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1), p + 3) - p)
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    return let(
        windows,
        lambda hashes: F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            let(starts(hashes), covered)
        ),
    )


def measured(docs: DataFrame) -> DataFrame:
    """Every document with the measures of the single-document rules. A null text is empty.

    Adds or replaces n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    tokens = words(F.col("text"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    counts = let(
        tokens,
        lambda t: F.struct(
            F.size(t).cast("long").alias("n_words"),
            F.length(F.array_join(t, "")).cast("long").alias("word_chars"),
            _repeated_words(t).cast("long").alias("n_repeat_words"),
        ),
    )
    dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    found = docs.withColumns(
        {
            "_counts": counts,
            "n_symbols": (F.size(F.split(text, r"[#*$%&|<>]", -1)) - 1).cast("long"),
            "n_dup_lines": dup_lines.cast("long"),
        }
    )
    found = found.withColumns(
        {n: F.col(f"_counts.{n}") for n in ("n_words", "word_chars", "n_repeat_words")}
    ).drop("_counts")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return found.withColumn("base_failed", failed)


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: its place, the hash of its normalised form, its words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.select(
            F.col("doc_id").alias("_doc"),
            F.col("source").alias("_host"),
            F.xxhash64(text).alias("_text"),
            F.posexplode(F.split(text, "\n")).alias("_place", "_line"),
        )
        .withColumn("_line", F.lower(F.btrim("_line", F.lit(SPACES))))
        .filter(F.col("_line") != "")
        .select(
            "_doc",
            "_host",
            "_text",
            "_place",
            F.xxhash64(F.regexp_replace("_line", SPACE_PATTERN, " ")).alias("_hash"),
            F.size(F.split("_line", SPACE_PATTERN)).alias("_words"),
        )
    )


def frequent_lines(docs: DataFrame, line_docs: int = LINE_DOCS) -> DataFrame:
    """Lines (_host, _hash, _first) that more than ``line_docs`` documents of a host hold.

    Equal texts count as one document, so that a group of copies does not make its own lines
    frequent. ``_first`` is the smallest id of a document that holds the line. Lines and texts are told
    apart by 64-bit hashes.
    """
    lines = _lines(docs)
    # Two steps: a line that a third of all documents hold is spread by document first.
    once = lines.groupBy("_host", "_hash", "_text").agg(F.min("_doc").alias("_doc"))
    counted = once.groupBy("_host", "_hash").agg(
        F.count(F.lit(1)).alias("_docs"), F.min("_doc").alias("_first")
    )
    return counted.filter(F.col("_docs") > line_docs).select("_host", "_hash", "_first")


def removed_lines(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Per document (_doc, _host, _text) the places of its frequent lines and their words.

    The first document that holds a line keeps it.
    """
    listed = frequent.select(
        F.col("_host").alias("_host2"), F.col("_hash").alias("_hash2"), F.col("_first")
    )
    found = _lines(docs).join(
        listed, same(F.col("_host"), F.col("_host2")) & (F.col("_hash") == F.col("_hash2"))
    )
    found = found.filter(~same(F.col("_doc"), F.col("_first")))
    # A repeated row has the same places again; they count once.
    found = found.dropDuplicates(["_doc", "_host", "_text", "_place"])
    return found.groupBy("_doc", "_host", "_text").agg(
        F.collect_set("_place").alias("_places"), F.sum("_words").alias("_gone")
    )


def judged(docs: DataFrame, least_left: float = LEAST_LEFT, with_text: bool = True) -> DataFrame:
    """Every document with its measures, ``kept`` and ``n_removed_words``.

    A document is kept if it passes the rules for single documents and its frequent lines leave
    at least ``least_left`` of its words and MIN_WORDS words. ``with_text`` keeps ``text``,
    without those lines; else no text crosses a shuffle. Null sources are one host, null texts are
    empty, repeated rows get the same verdict, other columns stay, whatever their names; those named
    like a measure are replaced.
    """
    docs, restored = shielded(docs, ["doc_id", "text", "source"], MEASURES)
    removed = removed_lines(docs, frequent_lines(docs))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = measured(docs).withColumn("_key", F.xxhash64(text))
    rows = rows if with_text else rows.drop("text")
    rows = rows.join(
        removed,
        same(F.col("doc_id"), F.col("_doc"))
        & same(F.col("source"), F.col("_host"))
        & (F.col("_key") == F.col("_text")),
        "left",
    ).withColumn("n_removed_words", F.coalesce(F.col("_gone"), F.lit(0)).cast("long"))
    left = F.col("n_words") - F.col("n_removed_words")
    spared = (F.col("n_removed_words") == 0) | (
        (left >= MIN_WORDS) & (left >= least_left * F.col("n_words"))
    )
    rows = rows.withColumn("kept", ~F.col("base_failed") & spared)
    if with_text:
        rest = F.filter(
            F.split(F.col("text"), "\n"), lambda _, i: ~F.array_contains(F.col("_places"), i)
        )
        cut = F.when(F.col("_places").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
        rows = rows.withColumn("text", cut)
    return restored(rows.drop("_key", "_doc", "_host", "_text", "_places", "_gone"))
