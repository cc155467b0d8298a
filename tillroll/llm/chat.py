"""Chat formatting whose output is read back by its own grammar.

Grammar: a conversation is a row of turns, a turn is ``### role: text</turn>`` and a line feed; a
turn holds its opening and its closing once. Three characters can conflict with it and have an escaped form: the backslash (``\\b``), the number
sign (``\\h``) and the less-than sign (``\\l``); in roles also the colon (``\\c``). The parser
undoes these forms everywhere, so a text that holds such a form itself does not come back as it
was. Every turn is first rendered as it is and parsed; where the parse is not the source it is
rendered escaped. Escaped content holds no control string, and every backslash starts a form, so
its parse is the source.

A conversation may be larger than a row can be, so output stands in one row per turn:
``conv_id, part, segment, loss_start, loss_length``; the formatted conversation is its segments in
the order of ``part``. The loss mask counts in code points from the segment's start. As every segment
holds one closing, at its end, and a closing ends in a character that none begins with, the joined
segments close where the segments do; reading back joins them and takes no border from the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

# Fixed values of the grammar.
OPEN, AFTER_ROLE, CLOSE, END = "### ", ": ", "</turn>", "\n"
FORMS = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_FORMS = (*FORMS, (":", "\\c"))
LOSS_ROLE = "assistant"


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column, forms: tuple[tuple[str, str], ...] = FORMS) -> Column:
    for plain, form in forms:  # the backslash first: later forms bring their own
        text = _replace(text, plain, form)
    return text


def unescape(text: Column, forms: tuple[tuple[str, str], ...] = FORMS) -> Column:
    for plain, form in reversed(forms):
        text = _replace(text, form, plain)
    return text


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(AFTER_ROLE), text, F.lit(CLOSE + END))


def parsed_role(segment: Column) -> Column:
    """The role of one turn: what stands between its opening and the first colon with a space."""
    head = F.substring_index(segment, AFTER_ROLE, 1)
    return unescape(F.substr(head, F.lit(len(OPEN) + 1)), ROLE_FORMS)


def parsed_text(segment: Column) -> Column:
    """The text of one turn: what follows its role, up to the first closing."""
    before = F.length(F.substring_index(segment, AFTER_ROLE, 1)) + len(AFTER_ROLE)
    body = F.substr(segment, before + 1)
    return unescape(F.substring_index(body, CLOSE, 1))


def reads_back(segment: Column, role: Column, text: Column) -> Column:
    """Whether the parser finds one turn in the segment, and that turn is the source."""
    once = [
        F.length(segment) - F.length(_replace(segment, mark, "")) == len(mark)
        for mark in (OPEN, CLOSE)
    ]
    return (
        once[0]
        & once[1]
        & segment.startswith(OPEN)
        & segment.endswith(CLOSE + END)
        & segment.contains(AFTER_ROLE)
        & (parsed_role(segment) == role)
        & (parsed_text(segment) == text)
    )


def formatted(turns: DataFrame) -> DataFrame:
    """The output rows of conversations (conv_id, turn, role, text).

    Null roles and texts are empty. Turns with equal numbers stand in the order of role and text,
    repeated rows stay. Null conversation ids are one conversation. Other columns are left behind.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    plain = rows.withColumn("segment", render(F.col("role"), F.col("text")))
    kept = reads_back(F.col("segment"), F.col("role"), F.col("text"))
    escaped = render(escape(F.col("role"), ROLE_FORMS), escape(F.col("text")))
    settled = plain.withColumn("segment", F.when(kept, F.col("segment")).otherwise(escaped))
    start = F.length(F.substring_index("segment", AFTER_ROLE, 1)) + len(AFTER_ROLE)
    length = F.length("segment") - start - len(CLOSE + END)
    learned = F.col("role") == LOSS_ROLE
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return settled.select(
        "conv_id",
        (F.row_number().over(order) - 1).cast("long").alias("part"),
        "segment",
        F.when(learned, start).otherwise(0).cast("long").alias("loss_start"),
        F.when(learned, length).otherwise(0).cast("long").alias("loss_length"),
    )


def read_back(output: DataFrame) -> DataFrame:
    """Turns (conv_id, part, role, text, loss, chars) parsed from output rows.

    The segments of a conversation are joined in order, and the grammar alone tells where its turns
    end: a closing ends a turn, and what follows the last closing would be one more, so a wrong border
    shows as other turns. ``loss`` is what the mask with the turn's number covers.
    """
    rows = F.sort_array(F.collect_list(F.struct("part", "segment", "loss_start", "loss_length")))
    whole = output.groupBy("conv_id").agg(rows.alias("rows")).select(
        "conv_id", F.split(F.array_join("rows.segment", ""), CLOSE + END).alias("turn"), "rows"
    )
    found = whole.select("conv_id", F.posexplode(F.arrays_zip("turn", "rows")).alias("part", "met"))
    turn, start, length = (F.col(f"met.{name}") for name in ("turn", "rows.loss_start", "rows.loss_length"))
    masked = F.coalesce(F.substr(turn, (start + 1).cast("int"), length.cast("int")), F.lit(""))
    return found.filter(turn != "").select(
        "conv_id",
        F.col("part").cast("long").alias("part"),
        parsed_role(turn).alias("role"),
        parsed_text(turn).alias("text"),
        unescape(masked).alias("loss"),
        (F.length(turn) + len(CLOSE + END)).cast("long").alias("chars"),
    )


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation that was read back; its digests need its turns in order."""
    line = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    held = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("part", line.alias("line"), "loss"))).alias("_turns"),
        F.sum(F.length("loss")).cast("long").alias("loss_chars"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    joined = lambda name: F.sha2(F.array_join(F.col(f"_turns.{name}"), ""), 256)
    return held.select(
        "conv_id",
        "n_turns",
        joined("line").alias("turns_sha256"),
        "loss_chars",
        joined("loss").alias("loss_sha256"),
        "formatted_chars",
    )
