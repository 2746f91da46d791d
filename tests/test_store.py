"""Transactional sinks (S3, S4) and shared temp tables."""

import os

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from casebook.plans import catalog
from casebook.sources import sinks
from casebook.sources.files import FileExists, Folder, snapshot
from casebook.sources.store import Conflict, StoredTable
from casebook.sources.temp_tables import TempTables, session_tables


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "id int, name string")


@pytest.fixture
def table(spark, tmp_path):
    return StoredTable(spark, str(tmp_path / "t"))


def test_replace_and_append(spark, table):
    assert table.versions() == [] and table.version() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.replace(frame(spark, [(1, "a"), (2, None)])) == 1
    assert table.append(spark.createDataFrame([("c", 3)], "name string, id long")) == 2
    assert rows(table.read()) == [(1, "a"), (2, None), (3, "c")] and rows(table.read(1)) == [(1, "a"), (2, None)]
    assert table.read().dtypes == [("id", "int"), ("name", "string")]
    with pytest.raises(ValueError):
        table.append(frame(spark, [(1, "a")]).drop("name"))
    assert table.replace(frame(spark, [])) == 3 and rows(table.read()) == []
    assert rows(table.read(2)) == [(1, "a"), (2, None), (3, "c")]


def test_replaced_from_itself(spark, table):
    table.replace(spark.range(1000).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("name")))
    table.replace(table.read().where("id % 2 = 0").withColumn("name", F.lit("y")))
    assert table.read().count() == 500 and rows(table.read().select("name").distinct()) == [("y",)]
    assert any(n.startswith("data/") for n in table.vacuum())
    assert table.read().count() == 500 and len(table.folder.names("data")) == 1 and table.versions() == [2]


def test_a_batch_is_added_once(spark, table):
    table.append(frame(spark, [(1, "a")]), batch="first")
    for _ in range(3):
        assert table.append(frame(spark, [(2, "b")]), batch="second") == 2
    assert rows(table.read()) == [(1, "a"), (2, "b")] and table.versions() == [1, 2]
    assert table.append(frame(spark, [(9, "z")]), batch="first") == 1
    assert rows(table.read()) == [(1, "a"), (2, "b")]


def test_a_job_that_dies_changes_nothing(spark, table):
    table.replace(frame(spark, [(1, "a"), (2, "b")]))
    bad = table.read().withColumn("name", F.when(F.col("id") == 2, F.raise_error(F.lit("killed"))).otherwise(F.col("name")))
    for change in (table.replace, table.append):
        with pytest.raises(Exception, match="killed"):
            change(bad)
        assert table.versions() == [1] and rows(table.read()) == [(1, "a"), (2, "b")]


def test_a_job_that_dies_before_its_commit_changes_nothing(spark, table, monkeypatch):
    table.replace(frame(spark, [(1, "a")]))
    with monkeypatch.context() as m:
        m.setattr(StoredTable, "_commit", lambda self, made: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            table.append(frame(spark, [(2, "b")]))
    assert rows(table.read()) == [(1, "a")] and len(table.folder.names("data")) == 2
    table.vacuum()
    assert rows(table.read()) == [(1, "a")] and len(table.folder.names("data")) == 1


def test_changes_at_once(spark, table, monkeypatch):
    """Another writer commits between this one's reading and its commit."""
    table.replace(frame(spark, [(1, "a")]))
    real = StoredTable._stage

    def late(batch):
        def stage(self, df, partitions):
            monkeypatch.setattr(StoredTable, "_stage", real)
            StoredTable(spark, self.folder.root).append(frame(spark, [(5, "other")]), batch=batch)
            return real(self, df, partitions)
        return stage

    monkeypatch.setattr(StoredTable, "_stage", late("other"))
    assert table.append(frame(spark, [(2, "b")]), batch="mine") == 3
    assert rows(table.read()) == [(1, "a"), (2, "b"), (5, "other")]
    monkeypatch.setattr(StoredTable, "_stage", late("same"))
    assert table.append(frame(spark, [(5, "other")]), batch="same") == 4  # the other one was this very batch
    assert table.read().count() == 4
    monkeypatch.setattr(StoredTable, "_stage", late("third"))
    with pytest.raises(Conflict):
        table.replace(table.read())
    with pytest.raises(Conflict):
        table.replace(frame(spark, []), expected=2)
    assert table.read().count() == 5


def test_partitions_are_replaced_alone(spark, table):
    table.replace(frame(spark, [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "x y/z")]), partitions=["name"])
    table.append(frame(spark, [(6, "a"), (7, "c")]))
    table.replace_partitions(frame(spark, [(10, "a"), (11, None)]))
    want = [(3, "b"), (5, "x y/z"), (7, "c"), (10, "a"), (11, None)]
    assert rows(table.read()) == want
    plan = table.read().where("name = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(name" in plan
    assert table.replace_partitions(frame(spark, [])) == 4 and rows(table.read()) == want
    with pytest.raises(Conflict):
        table.replace_partitions(frame(spark, [(1, "a")]), expected=2)
    table.vacuum()
    assert rows(table.read()) == want
    with pytest.raises(ValueError):
        StoredTable(spark, table.folder.root + "2").replace_partitions(frame(spark, []))


def test_sinks_use_the_store(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.replace(frame(spark, [(1, "a")]), path)
    for _ in range(2):
        sinks.append(frame(spark, [(2, "b")]), path, batch="k")
    stored = sinks.read_back(frame(spark, []), path)
    sinks.replace(stored.where("id > 1"), path)
    assert rows(sinks.read_back(stored, path)) == [(2, "b")]


def test_files_are_created_once(spark, tmp_path):
    folder = Folder(spark, str(tmp_path))
    folder.create_once("one", "text ä")
    with pytest.raises(FileExists):
        folder.create_once("one", "other")
    assert folder.read("one") == "text ä" and [n for n in folder.names() if not n.endswith(".crc")] == ["one"]


# --- temp tables ---------------------------------------------------------------------------------------------------------

def made(spark, tmp_path):
    path = str(tmp_path / "in")
    frame(spark, [(1, "a"), (2, "b")]).write.mode("overwrite").parquet(path)
    return path


def test_leases_share_and_remove(spark, tmp_path):
    path, builds = made(spark, tmp_path), []

    def build(df):
        return lambda: builds.append(1) or df.where("id > 1")

    with TempTables(spark, str(tmp_path / "temp")) as temp:
        def ask(params=(), **kw):
            df = spark.read.parquet(path)
            return temp.lease("big", df, build(df), params, **kw)

        a, b = ask(), ask(inputs=[path])
        assert len(builds) == 1 and a.path == b.path and rows(b.df) == [(2, "b")] and temp.leases("big") == 2
        other = ask(params=(1,))
        assert len(builds) == 2 and other.path != a.path
        temp.drop("big")
        assert os.path.isdir(a.path)
        a.release()
        a.release()  # twice is once
        assert rows(b.df) == [(2, "b")] and temp.leases("big") == 2
        b.release()
        assert not os.path.exists(a.path)
        other.release()
        assert not os.path.exists(other.path) and temp.names() == []
        with ask() as df:
            assert rows(df) == [(2, "b")]
        assert len(builds) == 3 and len(temp.names()) == 1
        temp.sweep()
        assert temp.names() == [] and os.listdir(tmp_path / "temp") == []
        held = ask()
    assert not os.path.exists(held.path) and not os.path.exists(tmp_path / "temp")


def test_changed_inputs_make_a_new_table(spark, tmp_path):
    path = made(spark, tmp_path)
    before = snapshot(spark, [path])
    with TempTables(spark, str(tmp_path / "temp")) as temp:
        first = temp.lease("t", spark.read.parquet(path), lambda: spark.read.parquet(path))
        frame(spark, [(3, "c")]).write.mode("append").parquet(path)
        assert snapshot(spark, [path]) != before
        second = temp.lease("t", spark.read.parquet(path), lambda: spark.read.parquet(path))
        assert rows(second.df) == [(1, "a"), (2, "b"), (3, "c")] and rows(first.df) == [(1, "a"), (2, "b")]
        first.release()
        assert not os.path.exists(first.path) and os.path.exists(second.path)


def test_no_files_have_a_snapshot(spark):
    assert snapshot(spark, []) == "no files"


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="generated tables not present")
def test_subscription_jobs_share_one_timeline(spark):
    temp = session_tables(spark)
    temp.drop("timeline")
    for _ in range(2):
        for name in ("direct_churn", "conversion_share", "plan_snapshot", "annual_upgrades", "downgrades"):
            catalog.QUERIES[name](spark, SF_SMALL).collect()
    assert temp.names().count("timeline") == 1
    assert len([n for n in os.listdir(temp.root.removeprefix("file:")) if n.startswith("timeline")]) == 1


def test_nothing_is_left_behind(tmp_path):
    """A session of its own: when its driver has ended, the shared folder holds no frozen or temp files."""
    import subprocess
    import sys

    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from casebook.session import build_session
from casebook.sources.sinks import freeze
from casebook.sources.temp_tables import session_tables
spark = build_session(master="local[2]", extra_conf={{"spark.checkpoint.dir": {str(tmp_path)!r}}})
df = spark.range(10)
assert freeze(df).count() == 10
df.write.parquet({str(tmp_path / "in")!r})
src = spark.read.parquet({str(tmp_path / "in")!r})
assert session_tables(spark).lease("t", src, lambda: src).df.count() == 10
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
    left = [os.path.join(d, f) for d, _, files in os.walk(tmp_path) for f in files if "/in" not in d and f.endswith(".parquet")]
    assert left == []
