"""URL lists with dates: entries become validity intervals, captures meet those active at fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import same, shielded

PERIOD_DAYS = 30
ALLOW = "allow"


def host_of(url: Column) -> Column:
    """The host of an http or https address in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def section_of(url: Column) -> Column:
    """The first part of the path; empty if there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)


def patterns_of(url: Column) -> Column:
    """All patterns that fit an address: its host, the domains above it, and host with section."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    section = F.array(F.concat(host_of(url), F.lit("/"), section_of(url)))
    both = F.when(section_of(url) == "", domains).otherwise(F.concat(domains, section))
    return F.when(host_of(url) == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(both)
    )


def validity(entries: DataFrame) -> DataFrame:
    """Entries (pattern, day, action) as intervals (pattern, action, since, until).

    An entry holds from its day until the next one for the same pattern; the last has no end. Of
    several entries for one pattern and day the one with the largest action text counts, so a block
    beats an allow. Entries without pattern, day or action are left out.
    """
    daily = entries.dropna(subset=["pattern", "day", "action"]).groupBy("pattern", "day")
    daily = daily.agg(F.max("action").alias("action"))
    following = F.lead("day").over(Window.partitionBy("pattern").orderBy("day"))
    return daily.select("pattern", "action", F.col("day").alias("since"), following.alias("until"))


def _period(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / days).cast("int")


def active_at(captures: DataFrame, entries: DataFrame, period_days: int = PERIOD_DAYS) -> DataFrame:
    """Per address and day (url, day) of the captures, every pattern active then with its action.

    Intervals are cut into periods, so the join is by pattern and period: a popular host is spread
    over its periods, and a capture meets no entries of other times. Equal captures meet once.
    """
    intervals = validity(entries)
    # One value: an interval without end is followed as far as there are captures.
    last = F.lit(captures.agg(F.max("day")).first()[0]).cast("date")
    cut = intervals.select(
        "pattern",
        "action",
        "since",
        "until",
        F.explode(
            F.when(
                F.col("since") <= last,
                F.sequence(
                    _period(F.col("since"), period_days),
                    _period(
                        F.least(F.coalesce(F.date_sub("until", 1), last), last),
                        period_days,
                    ),
                ),
            )
        ).alias("period"),
    )
    asked = (
        captures.select("url", "day")
        .dropna()
        .distinct()
        .withColumn("pattern", F.explode(patterns_of(F.col("url"))))
        .withColumn("period", _period(F.col("day"), period_days))
    )
    at = (F.col("a.day") >= F.col("i.since")) & (
        F.col("i.until").isNull() | (F.col("a.day") < F.col("i.until"))
    )
    keys = (F.col("a.pattern") == F.col("i.pattern")) & (F.col("a.period") == F.col("i.period"))
    return asked.alias("a").join(cut.alias("i"), keys & at).select(
        "a.url", "a.day", "a.pattern", "i.action", "i.since"
    )


def filtered(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every capture (url, day, more columns) with n_active, pattern, since, action and kept.

    The longest active pattern decides, equal lengths by text. Without an active pattern, and for
    null addresses or days, the action is allow. Repeated captures each get their row. Columns of
    the captures with these names are replaced; others stay, whatever their names.
    """
    captures, restored = shielded(
        captures, ["url", "day"], ["n_active", "pattern", "since", "action", "kept"]
    )
    rank = F.struct(F.length("pattern"), F.col("pattern"))
    verdicts = (
        active_at(captures, entries)
        .groupBy("url", "day")
        .agg(
            F.count(F.lit(1)).alias("n_active"),
            F.max_by(F.struct("pattern", "since", "action"), rank).alias("_best"),
        )
        .select(
            F.col("url").alias("_url"),
            F.col("day").alias("_day"),
            F.col("n_active").alias("_active"),
            "_best",
        )
    )
    met = captures.join(
        verdicts, same(F.col("url"), F.col("_url")) & same(F.col("day"), F.col("_day")), "left"
    )
    action = F.coalesce(F.col("_best.action"), F.lit(ALLOW))
    met = met.withColumns(
        {
            "n_active": F.coalesce(F.col("_active"), F.lit(0)).cast("long"),
            "pattern": F.col("_best.pattern"),
            "since": F.col("_best.since"),
            "action": action,
            "kept": action == ALLOW,
        }
    )
    return restored(met.drop("_url", "_day", "_active", "_best"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures. The table has no dates, so the fetch day follows from the page id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7, F.lit(366)).cast("int"))
    return pages.select("page_id", "url", day.alias("day"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated list entries that the pages themselves give rise to.

    A page with a tracking parameter puts its host with section on the list, from 30 days after
    its fetch; one with a fragment takes its host off; one below www. lists the domain above it.
    """
    url, host = F.col("url"), host_of(F.col("url"))
    rows = captures_of(pages)
    later = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 13 + 30, F.lit(366)).cast("int"))
    tracked = rows.filter(url.contains("utm_")).select(
        F.concat(host, F.lit("/"), section_of(url)).alias("pattern"),
        later.alias("day"),
        F.lit("block").alias("action"),
    )
    cleared = rows.filter(url.contains("#")).select(
        host.alias("pattern"), later.alias("day"), F.lit(ALLOW).alias("action")
    )
    above = rows.filter(host.startswith("www.")).select(
        F.substr(host, F.lit(5)).alias("pattern"), later.alias("day"), F.lit("block").alias("action")
    )
    return tracked.unionByName(cleared).unionByName(above)
