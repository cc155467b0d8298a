"""Every report goes to a table of its own, which is replaced; or all of them appear as one set."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tillroll.storage import children, read_text, remove, write_text

REPORTS_AT_ONCE = 4


def write_jdbc(
    df: DataFrame, table: str, options: Mapping[str, str], mode: str = "overwrite"
) -> None:
    """Write to a database table; url, driver, user and password come from the caller."""
    if "url" not in options:
        raise ValueError("options need the database's url")
    df.write.format("jdbc").options(**{**options, "dbtable": table}).mode(mode).save()


def write_files(df: DataFrame, table: str, folder: str, format: str = "parquet") -> None:
    """Write to a folder named after the table."""
    df.write.format(format).mode("overwrite").save(f"{folder.rstrip('/')}/{table}")


def read_published(spark: SparkSession, folder: str, table: str, format: str = "parquet") -> DataFrame:
    """A table of the newest whole set below the folder."""
    sets = FileSet(spark, folder).published()
    if not sets:
        raise FileNotFoundError(f"no whole set of tables below {folder}")
    return spark.read.format(format).load(f"{folder.rstrip('/')}/{sets[-1]}/{table}")


class FileSet:
    """Writes tables below a folder so that readers get all of one run or all of the run before.

    A run has a folder of its own, whose name sorts by time. When every table is written, a file that
    lists them, the manifest, is put beside them: only then the set counts, and one small file either
    is there or is not, on any store. The ``kept`` newest sets stay, for readers that have begun on
    an older one; a run that fails leaves nothing.
    """

    MANIFEST = "_TABLES"

    def __init__(self, spark: SparkSession, folder: str, format: str = "parquet", kept: int = 2):
        if kept < 1:
            raise ValueError("at least the set just written must be kept")
        self.spark, self.folder, self.format, self.kept = spark, folder.rstrip("/"), format, kept
        now = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        self.run = f"run-{now}-{uuid.uuid4().hex[:8]}"

    def __call__(self, df: DataFrame, table: str) -> None:
        write_files(df, table, f"{self.folder}/{self.run}", self.format)

    def published(self) -> list[str]:
        """The names of the whole sets, the newest last."""
        names = [name for name in children(self.spark, self.folder) if name.startswith("run-")]
        whole = (n for n in names if self.MANIFEST in children(self.spark, f"{self.folder}/{n}"))
        return sorted(whole)

    def tables(self, run: str) -> list[str]:
        return json.loads(read_text(self.spark, f"{self.folder}/{run}/{self.MANIFEST}"))

    def commit(self, tables: Sequence[str]) -> None:
        write_text(self.spark, f"{self.folder}/{self.run}/{self.MANIFEST}", json.dumps(list(tables)))
        for old in self.published()[: -self.kept]:
            # Without its manifest first, so that no reader finds half a set.
            remove(self.spark, f"{self.folder}/{old}/{self.MANIFEST}")
            remove(self.spark, f"{self.folder}/{old}")

    def discard(self) -> None:
        remove(self.spark, f"{self.folder}/{self.run}")


class TableSet:
    """Writes tables to a database beside the published ones and renames all of them together.

    ``run`` gets the statements of a switch in order, for one connection and transaction.
    """

    def __init__(self, options: Mapping[str, str], run: Callable[[list[str]], None]):
        self.options, self.run_statements = options, run

    def __call__(self, df: DataFrame, table: str) -> None:
        write_jdbc(df, f"{table}__new", self.options)

    def statements(self, tables: Sequence[str]) -> list[str]:
        dropped = [f"DROP TABLE IF EXISTS {table}__old" for table in tables]
        if self.options["url"].startswith(("jdbc:mysql:", "jdbc:mariadb:")):
            # These databases end a transaction at every such statement, but rename many tables in one.
            made = [f"CREATE TABLE IF NOT EXISTS {table} LIKE {table}__new" for table in tables]
            renames = ", ".join(f"{table} TO {table}__old, {table}__new TO {table}" for table in tables)
            return [*dropped, *made, f"RENAME TABLE {renames}", *dropped]
        renames = [
            statement
            for table in tables
            for statement in (
                f"ALTER TABLE IF EXISTS {table} RENAME TO {table}__old",
                f"ALTER TABLE {table}__new RENAME TO {table}",
            )
        ]
        return [*dropped, *renames, *dropped]

    def commit(self, tables: Sequence[str]) -> None:
        self.run_statements(self.statements(tables))

    def discard(self) -> None:
        """What was written beside the published tables is replaced by the next run."""


def publish(
    reports: Mapping[str, DataFrame],
    write: Callable[[DataFrame, str], None],
    at_once: int = REPORTS_AT_ONCE,
    waits_for: Mapping[str, Sequence[Future]] | None = None,
) -> list[str]:
    """Write each report under its name, several at a time; returns the names.

    Most reports are small jobs that leave a cluster idle when run one after the other. Those that wait
    for nothing come first; ``waits_for`` names what must have ended before a report begins. If ``write`` has
    ``commit`` and ``discard``, it is told the names when all reports are written, or that one failed.
    """
    waits = waits_for or {}

    def one(name: str) -> None:
        for awaited in waits.get(name, ()):
            awaited.result()
        write(reports[name], name)

    with ThreadPoolExecutor(at_once) as pool:
        order = sorted(reports, key=lambda name: len(waits.get(name, ())))
        started = {name: pool.submit(one, name) for name in order}
    failed = {name: started[name].exception() for name in reports if started[name].exception()}
    if failed:
        if hasattr(write, "discard"):
            write.discard()
        raise ExceptionGroup(f"not published: {', '.join(failed)}", list(failed.values()))
    if hasattr(write, "commit"):
        write.commit(list(reports))
    return list(reports)
