"""Publishing. No database is started here: the JDBC writer is checked up to the driver call."""

from pathlib import Path

import pytest

import micro
from checks.oracles import PUBLISHED
from micro import rows
from tillroll import __main__ as cli, job, sinks, sizing, storage
from tillroll.operators import DuplicateKeys
from tillroll.plans import prepare, rollups
from tillroll.sources import read_inputs


class Recorder:
    """Stands in for a DataFrame and notes what its writer is told."""

    def __init__(self):
        self.calls = []

    @property
    def write(self):
        return self

    def __getattr__(self, name):
        def note(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return note


def test_jdbc_writer_gets_the_callers_options():
    frame = Recorder()
    sinks.write_jdbc(frame, "totals", {"url": "jdbc:x:y", "user": "u", "password": "p", "driver": "d"})
    assert frame.calls == [
        ("format", ("jdbc",), {}),
        ("options", (), {"url": "jdbc:x:y", "user": "u", "password": "p", "driver": "d", "dbtable": "totals"}),
        ("mode", ("overwrite",), {}),
        ("save", (), {}),
    ]


def test_jdbc_options_reach_the_source(spark):
    with pytest.raises(Exception, match="no.such.Driver"):
        sinks.write_jdbc(spark.range(1), "t", {"url": "jdbc:none:x", "driver": "no.such.Driver"})
    with pytest.raises(ValueError, match="url"):
        sinks.write_jdbc(spark.range(1), "t", {})


def test_files_are_replaced(spark, tmp_path):
    sinks.write_files(spark.range(5), "t", str(tmp_path))
    sinks.write_files(spark.range(2), "t", f"{tmp_path}/")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2


def test_every_report_is_published_to_its_own_table(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    cached = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    source.mkdir()
    before = set(Path(storage.shared_folder(spark)).glob("fact-*"))
    names = job.run(spark, micro.write(source), lambda df, name: sinks.write_files(df, name, str(target)))
    assert names == list(PUBLISHED)
    # The working copy is gone.
    assert set(Path(storage.shared_folder(spark)).glob("fact-*")) == before
    read = {name: spark.read.parquet(f"{target}/{name}") for name in names}
    assert rows(read["top5_stores_by_province"], "store_num") != rows(read["top10_cat_by_dept"], "category")
    assert read["top_stores"].count() == 10 and read["totals"].count() == 12
    assert read["trends"].columns == ["customer_type", "trans_dt", "total", "measure"]
    assert rows(read["loyalty_vs_nonloyalty"]) == [(80.5, 57.0, "141.0%")]
    # Nothing more stays cached.
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == cached


def test_a_set_of_reports_appears_as_a_whole(spark, tmp_path):
    folder = str(tmp_path / "out")
    reports = {"a": spark.range(3), "b": spark.range(5)}
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, folder, "a")
    first = sinks.FileSet(spark, folder)
    assert sinks.publish(reports, first) == ["a", "b"]
    assert first.tables(first.run) == ["a", "b"]
    assert sinks.read_published(spark, folder, "b").count() == 5
    # One report of the next set fails: the set before it stays, and nothing of the new one does.
    broken = spark.range(2).selectExpr("raise_error('broken') AS x")
    failing = sinks.FileSet(spark, folder)
    with pytest.raises(ExceptionGroup, match="not published: b"):
        sinks.publish({"a": spark.range(9), "b": broken}, failing)
    assert sinks.read_published(spark, folder, "a").count() == 3
    assert first.published() == [first.run]
    assert [p.name for p in (tmp_path / "out").iterdir()] == [first.run]
    # Tables that are not all written yet are not read.
    half = sinks.FileSet(spark, folder)
    half(spark.range(100), "a")
    assert sinks.read_published(spark, folder, "a").count() == 3
    half.commit(["a"])
    assert sinks.read_published(spark, folder, "a").count() == 100
    for n in (1, 2):
        sinks.publish({"a": spark.range(n)}, sinks.FileSet(spark, folder))
    assert sinks.read_published(spark, folder, "a").count() == 2
    assert len(first.published()) == 2


def test_tables_of_a_database_are_renamed_together():
    asked = []
    tables = sinks.TableSet({"url": "jdbc:mysql://h/d"}, asked.extend)
    frame = Recorder()
    tables(frame, "t")
    assert frame.calls[1][2]["dbtable"] == "t__new"
    tables.commit(["t", "u"])
    assert asked[4] == "RENAME TABLE t TO t__old, t__new TO t, u TO u__old, u__new TO u"
    other = sinks.TableSet({"url": "jdbc:postgresql://h/d"}, asked.extend).statements(["t"])
    assert other == [
        "DROP TABLE IF EXISTS t__old",
        "ALTER TABLE IF EXISTS t RENAME TO t__old",
        "ALTER TABLE t__new RENAME TO t",
        "DROP TABLE IF EXISTS t__old",
    ]


def test_the_raw_fact_is_read_once_and_never_joined(spark, tmp_path):
    fact, location, product = read_inputs(spark, micro.write(tmp_path))
    scans = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    plans = {}

    def write(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        sinks.write_files(df, name, str(tmp_path / "out"))

    job.publish_all(fact.mapInArrow(counted, fact.schema), location, product, write)
    assert scans.value == 9
    assert "trans_dt" not in plans["quality"] and "collector_key#" not in plans["quality"]
    got = spark.read.parquet(str(tmp_path / "out" / "quality"))
    assert got.columns == list(prepare.QUALITY)
    assert rows(got) == rows(prepare.quality(prepare.enrich(fact, location, product)))


def test_quality_of_an_empty_delivery(spark, tmp_path):
    fact, location, product = read_inputs(spark, micro.write(tmp_path))
    empty = prepare.checked(fact.limit(0))
    stores = rollups.store_sales(empty, location, prepare.FLAGS)
    found = prepare.quality_of_rollups(stores, rollups.category_sales(empty, product))
    assert rows(found) == [(0,) * 9]


def test_repeated_dimension_keys_stop_the_batch(spark, tmp_path):
    micro.write(tmp_path)
    (tmp_path / "location_2.csv").write_text("store_location_key,province,store_num\n1,QC,999\n")
    written = []
    with pytest.raises(DuplicateKeys, match="store_location_key"):
        job.run(spark, str(tmp_path), lambda df, name: written.append(name))
    assert not written


def test_command_line(monkeypatch):
    monkeypatch.setenv("SECRET", "s")
    args = cli.parse(["--input", "in", "--jdbc-url", "jdbc:x", "--jdbc-user", "u", "--jdbc-password-env", "SECRET"])
    assert cli.jdbc_options(args) == {"url": "jdbc:x", "user": "u", "password": "s"}
    with pytest.raises(SystemExit):
        cli.parse(["--input", "in"])
    with pytest.raises(SystemExit):
        cli.parse(["--input", "in", "--output", "o", "--jdbc-url", "jdbc:x"])


def test_settings_grow_with_the_delivery_and_stay_bounded():
    def sized(bytes_):
        return tuple(int(value) for value in sizing.settings_for(bytes_).values())

    small, medium, large = sized(0), sized(10**12), sized(10**14)
    assert small == (128 * sizing.MIB, 200)
    assert medium == (128 * sizing.MIB, 931)
    assert 200 * sizing.MIB < large[0] <= 256 * sizing.MIB and large[1] == 20_000


def test_settings_given_explicitly_are_kept(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        assert sizing.apply(spark, 10**14).keys() == {"spark.sql.files.maxPartitionBytes"}
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
