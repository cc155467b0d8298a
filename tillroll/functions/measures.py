"""Typing, classification and ratio expressions. All are safe with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillroll.schema import (
    CUSTOMER_TYPES,
    LOYALTY,
    MEASURE_PRECISION,
    MEASURE_SCALE,
    NON_LOYALTY,
)


def measure(col: Column, precision: int = MEASURE_PRECISION, scale: int = MEASURE_SCALE) -> Column:
    """Text to an exact decimal; empty or malformed text counts as zero.

    A number that is too large for the type is an error: as zero it would be lost without a trace.
    """
    typed = col.try_cast(f"decimal({precision},{scale})")
    number = col.try_cast("double")
    # "NaN" and "Infinity" read as double but are no amounts.
    amount = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    large = F.concat(F.lit(f"too large for decimal({precision},{scale}): "), col.cast("string"))
    zero = F.lit(0).cast(f"decimal({precision},{scale})")
    # Only a text that is no decimal is read a second time.
    return F.coalesce(typed, F.when(amount, F.raise_error(large)).otherwise(zero))


def loses_digits(col: Column, precision: int = MEASURE_PRECISION, scale: int = MEASURE_SCALE) -> Column:
    """True where ``measure`` would change the value: malformed text or more decimals than the scale.

    Decimals are told by the text's own digits. A number with an exponent is compared as a double.
    """
    typed = col.try_cast(f"decimal({precision},{scale})")
    point = F.instr(col, ".")
    cut = (point > 0) & (F.length(col) - point > scale) & col.rlike(f"\\.[0-9]{{{scale}}}[0-9]*[1-9]")
    has_exponent = col.contains("e") | col.contains("E")
    changed = F.when(has_exponent, typed.cast("double") != col.try_cast("double")).otherwise(cut)
    return col.isNotNull() & (typed.isNull() | changed)


def customer_type(collector_key: Column, null_as: str = LOYALTY) -> Column:
    """Negative keys are outside the loyalty program.

    Keys that are null, malformed or zero get ``null_as``.
    """
    if null_as not in CUSTOMER_TYPES:
        raise ValueError(f"null_as must be one of {CUSTOMER_TYPES}, not {null_as!r}")
    number = F.nanvl(collector_key.try_cast("double"), F.lit(None).cast("double"))
    if null_as == NON_LOYALTY:
        return F.when(number > 0, F.lit(LOYALTY)).otherwise(F.lit(NON_LOYALTY))
    return F.when(number < 0, F.lit(NON_LOYALTY)).otherwise(F.lit(LOYALTY))


def count_not_null(name: str, nan_as_null: bool = False) -> Column:
    """Number of present values of a column; NaN counts as absent if asked."""
    col = F.col(name)
    present = col.isNotNull()
    if nan_as_null:
        present = present & ~F.isnan(col)
    return F.count_if(present).alias(name)


def exact(total: Column) -> Column:
    """Edge type of a money or unit total: the exact decimal becomes a double."""
    return total.cast("double")


def whole(total: Column) -> Column:
    """A total rounded half away from zero to a whole number."""
    return F.round(total).cast("double")


def percent(part: Column, base: Column) -> Column:
    """``part`` as a percentage of ``base``; null where the base is zero."""
    return F.try_divide(part.cast("double") * 100, base.cast("double"))


def percent_label(part: Column, base: Column) -> Column:
    """The percentage rounded to a whole number, as text such as ``275.0%``."""
    return F.concat(F.round(percent(part, base)).cast("string"), F.lit("%"))
