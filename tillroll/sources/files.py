"""Delivered files: listing, roles by name, and headers that differ from file to file."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillroll.schema import DEFAULT_ROLE, FACT, HEADER_ALIASES, LOCATION, PRODUCT, ROLE_RULES

# How many headers are looked up at the same time; each is a one-row job.
HEADER_LOOKUPS = 16

# More than any file has: such scans give every file a task of its own.
WHOLE_FILE = 1 << 50


class UnknownHeader(ValueError):
    """A file's header does not name every declared column exactly once."""


def read_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with a header row, every column as text; empty fields are null.

    All paths must share one header; ``conform`` takes files whose headers differ.
    """
    return spark.read.option("header", True).csv(paths if isinstance(paths, str) else list(paths))


def split_lines(spark: SparkSession, paths: str | Sequence[str], separator: str = ",") -> DataFrame:
    """Each text line as an array of fields, without any quoting rules."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return lines.select(F.split("value", f"\\Q{separator}\\E").alias("fields"))


def has_rows(spark: SparkSession, path: str) -> bool:
    """False for a missing path and for files without any line."""
    try:
        return not spark.read.text(path).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _folder(spark: SparkSession, root: str) -> str:
    """``root`` up to its first wildcard, as the file system spells it in full."""
    parts = root.split("/")
    wild = next((k for k, part in enumerate(parts) if re.search(r"[*?\[{]", part)), None)
    if wild is not None:
        parts = parts[:wild]
    fixed = "/".join(parts) or ("/" if root.startswith("/") else ".")
    path = spark._jvm.org.apache.hadoop.fs.Path(fixed)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.makeQualified(path).toString()


def discover(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file below ``root`` as (path, name, bytes); contents are not read.

    ``name`` is the path relative to ``root``, of a pattern relative to its part before the first
    wildcard; of a root that is a file, its last part.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    below = _folder(spark, root).rstrip("/") + "/"
    name = F.when(
        F.col("path").startswith(below), F.substring("path", F.lit(len(below) + 1), F.length("path"))
    ).otherwise(F.element_at(F.split("path", "/"), -1))
    return reader.load(root).select(
        "path",
        name.alias("name"),
        F.col("length").alias("bytes"),
    )


def _role(name: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    first, *others = rules
    role = F.when(name.contains(first[0]), first[1])
    for text, value in others:
        role = role.when(name.contains(text), value)
    return role.otherwise(default)


def route(
    files: DataFrame,
    rules: Sequence[tuple[str, str]] = ROLE_RULES,
    default: str = DEFAULT_ROLE,
) -> DataFrame:
    """Add each discovered file's role: that of the first rule whose text its name holds."""
    return files.withColumn("role", _role(F.col("name"), rules, default))


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    return tuple(read_csv(spark, path).columns)


def _one_task_a_file(spark: SparkSession) -> SparkSession:
    """A session of the same settings whose scans never split a file nor put two in a task."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.files.maxPartitionBytes", str(WHOLE_FILE))
    session.conf.set("spark.sql.files.openCostInBytes", str(WHOLE_FILE))
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return session


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files with each header, both in a fixed order; files without any line are left out.

    One job looks at all files: a task a file, which stops after the first line. Files are grouped by that
    line in the cluster, and one file of each group is asked for its columns.
    """

    def first_lines(batches):  # local, so that workers need not import this package
        for batch in batches:
            for k, line in enumerate(batch.column("value").to_pylist()):
                if line.strip():
                    yield batch.slice(k, 1)
                    return

    lines = _one_task_a_file(spark).read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), "value")
    found = lines.mapInArrow(first_lines, "path string, value string")
    groups = found.groupBy("value").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    # Spark names a row's file as an escaped address.
    listed = sorted([unquote(path) for path in row["paths"]] for row in groups.collect())
    with ThreadPoolExecutor(HEADER_LOOKUPS) as pool:
        columns = list(pool.map(lambda members: _header(spark, members[0]), listed))
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for header, members in zip(columns, listed):
        by_header[header] += members
    return dict(by_header)


def _selection(
    header: Sequence[str], schema: T.StructType, aliases: Mapping[str, str], paths: Sequence[str]
) -> list[Column]:
    found: dict[str, list[str]] = defaultdict(list)
    for spelled in header:
        plain = spelled.strip().lower()
        found[aliases.get(plain, plain)].append(spelled)
    wrong = [name for name in schema.names if len(found[name]) != 1]
    if wrong:
        raise UnknownHeader(
            f"columns {wrong} are missing or repeated in header {list(header)} of {list(paths)}"
        )
    return [F.col(f"`{found[name][0]}`").alias(name) for name in schema.names]


def conform(
    spark: SparkSession,
    paths: Iterable[str],
    schema: T.StructType = FACT,
    aliases: Mapping[str, str] = HEADER_ALIASES,
    by_path: bool = False,
) -> DataFrame:
    """One relation of the declared columns from files in any column order and known spelling.

    A path is a file or a folder. The headers of all files are found by one job; with ``by_path`` the
    files of a folder must share a header, which is looked up once per path, and the driver holds no
    more than the given paths. Files with equal headers become one scan, so the plan grows with the
    number of different headers, not of files. Every file's own header is checked again when it is
    scanned, so a file that changes fails instead of swapping columns. Files without any line are
    passed over.
    """
    paths = list(dict.fromkeys(paths))
    if not paths:
        raise ValueError("no input files")
    if by_path:
        with ThreadPoolExecutor(min(HEADER_LOOKUPS, len(paths))) as pool:
            looked_up = list(pool.map(lambda path: _header(spark, path), paths))
        groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
        for path, header in zip(paths, looked_up):
            if header:
                groups[header].append(path)
    else:
        groups = headers(spark, paths)
    if not groups:
        raise ValueError(f"no lines in {paths}")

    scans = []
    for header, members in groups.items():
        columns = _selection(header, schema, aliases, members)
        as_text = T.StructType([T.StructField(name, T.StringType()) for name in header])
        scan = (
            spark.read.schema(as_text)
            .option("header", True)
            .option("enforceSchema", False)
            .csv(members)
        )
        scans.append(scan.select(*columns))
    return reduce(DataFrame.unionByName, scans)


def read_inputs(
    spark: SparkSession,
    root: str,
    rules: Sequence[tuple[str, str]] = ROLE_RULES,
    glob: str | None = None,
    by_folder: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Discover, route and conform a delivery: (fact, location, product).

    With ``by_folder`` the files of a role in one folder must share a header, which is looked up
    once per folder: for deliveries of very many files.
    """
    listed = route(discover(spark, root, glob), rules)
    unit = F.regexp_replace("path", "/[^/]*$", "") if by_folder else F.col("path")
    units = listed.select(unit.alias("path"), "role").distinct()
    paths: dict[str, list[str]] = defaultdict(list)
    roles: dict[str, str] = {}
    # The scans need every path on the driver; there is one row per file or folder.
    for row in units.orderBy("path").collect():
        if roles.setdefault(row.path, row.role) != row.role:
            raise ValueError(f"{row.path} holds files of several roles")
        paths[row.role].append(row.path)
    missing = [role for role in ("fact", "location", "product") if not paths[role]]
    if missing:
        raise ValueError(f"no {' and no '.join(missing)} file below {root}")
    return (
        conform(spark, paths["fact"], FACT, by_path=by_folder),
        conform(spark, paths["location"], LOCATION, by_path=by_folder),
        conform(spark, paths["product"], PRODUCT, by_path=by_folder),
    )
