"""Transaction dates arrive as text, ``m/d/yyyy`` or ``yyyy-m-d``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The two accepted spellings of a date, with a month between 1 and 12.
MONTH = "(0?[1-9]|1[0-2])"
SLASH_DATE = f"^{MONTH}/[0-9]{{1,2}}/[0-9]{{4}}$"
HYPHEN_DATE = f"^[0-9]{{4}}-{MONTH}-[0-9]{{1,2}}$"


def has_known_date(trans_dt: Column) -> Column:
    """True if the text has one of the accepted spellings; null for null."""
    return trans_dt.rlike(f"{SLASH_DATE}|{HYPHEN_DATE}")


def month_of_known(trans_dt: Column) -> Column:
    """First day of the month of a text that passed ``has_known_date``.

    The pieces are cut by position, without another look at the pattern.
    """
    slash = trans_dt.contains("/")
    year = F.when(slash, F.substring_index(trans_dt, "/", -1)).otherwise(F.substring(trans_dt, 1, 4))
    month = F.when(slash, F.substring_index(trans_dt, "/", 1)).otherwise(
        F.substring_index(F.substring(trans_dt, 6, 2), "-", 1)
    )
    return F.concat_ws("-", year, month, F.lit("1")).try_cast("date")


def month_start(trans_dt: Column) -> Column:
    """First day of the transaction's month; null for any other spelling."""
    return F.when(has_known_date(trans_dt), month_of_known(trans_dt))


def date_label(month: Column) -> Column:
    """Result spelling of a month: ``MM-01-yyyy``."""
    return F.date_format(month, "MM-dd-yyyy")


def padded_month(month: Column) -> Column:
    """Month piece as two digits."""
    return F.lpad(month, 2, "0")


def month_index(month: Column) -> Column:
    """Months since year 0, so that neighbouring months differ by one."""
    return (F.year(month) * 12 + F.month(month)).cast("int")
