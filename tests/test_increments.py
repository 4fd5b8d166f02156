"""Exports whose cost is that of the new slices."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.plans import loads
from tidemill.sinks import tables

BY = {"day": "date", "batch": "int"}


def store(spark, path, rows):
    df = spark.createDataFrame(rows, "id INT, day DATE, batch INT")
    tables.replace_slice(df, path, list(BY))


def d(day):
    return dt.date(2024, 1, day)


@pytest.fixture
def folders(tmp_path):
    return f"{tmp_path}/stored", f"{tmp_path}/sync"


def exported(spark, folder):
    rows = spark.read.parquet(f"{folder}/export").collect()
    return sorted((r["id"], r["run_id"]) for r in rows)


def test_runs_read_new_slices_only(spark, folders, monkeypatch):
    source, folder = folders
    read = []
    plain = loads.read_slices

    def spied(spark, path, slices, types):
        df = plain(spark, path, slices, types)
        if path == source:
            read.append(sorted(x.split(source, 1)[1].rsplit("/", 1)[0] for x in df.inputFiles()))
        return df

    monkeypatch.setattr(loads, "read_slices", spied)
    store(spark, source, [(1, d(1), 0), (2, d(2), 0), (3, None, 0)])
    assert loads.sync_slices(spark, source, folder, "a", BY) == {"rows": 3, "slices": 3}
    # A late row of the first day, a row of a new day, one more without a day.
    store(spark, source, [(4, d(1), 1), (5, d(3), 1), (6, None, 1)])
    assert loads.sync_slices(spark, source, folder, "b", BY, ["id"]) == {"rows": 3, "slices": 3}
    assert read[1] == ["/day=2024-01-01/batch=1", "/day=2024-01-03/batch=1", "/day=__HIVE_DEFAULT_PARTITION__/batch=1"]
    assert loads.sync_slices(spark, source, folder, "c", BY) == {"rows": 0, "slices": 0}
    assert len(read) == 2
    assert exported(spark, folder) == [(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "b"), (6, "b")]


def test_a_changed_slice_replaces_its_export(spark, folders):
    source, folder = folders
    store(spark, source, [(1, d(1), 0), (2, d(1), 1)])
    loads.sync_slices(spark, source, folder, "a", BY)
    store(spark, source, [(7, d(1), 1)])
    assert loads.sync_slices(spark, source, folder, "b", BY) == {"rows": 1, "slices": 1}
    assert exported(spark, folder) == [(1, "a"), (7, "b")]


def test_a_run_lost_before_its_marks_is_made_good(spark, folders, monkeypatch):
    source, folder = folders
    store(spark, source, [(1, d(1), 0), (2, d(2), 0)])
    plain = loads.replace_slice

    def lost(df, path, *args, **kw):
        if path.endswith("marks"):
            raise RuntimeError("driver lost")
        plain(df, path, *args, **kw)

    monkeypatch.setattr(loads, "replace_slice", lost)
    with pytest.raises(RuntimeError):
        loads.sync_slices(spark, source, folder, "a", BY)
    monkeypatch.setattr(loads, "replace_slice", plain)
    assert loads.sync_slices(spark, source, folder, "b", BY)["rows"] == 2
    assert exported(spark, folder) == [(1, "b"), (2, "b")]


def test_look_back_leaves_older_days_alone(spark, folders):
    source, folder = folders
    store(spark, source, [(1, d(1), 0), (2, d(9), 0)])
    assert [x.values for x in loads.pending_slices(spark, source, folder, BY, "2024-01-05")] == [("2024-01-09", "0")]
    assert loads.sync_slices(spark, source, folder, "a", BY, oldest="2024-01-05")["rows"] == 1
    assert loads.sync_slices(spark, source, folder, "b", BY)["rows"] == 1
    assert exported(spark, folder) == [(1, "b"), (2, "a")]


def test_empty_source(spark, folders):
    source, folder = folders
    assert loads.sync_slices(spark, source, folder, "a", BY) == {"rows": 0, "slices": 0}


def test_rows_without_a_key_are_counted(spark, tmp_path):
    stored = spark.createDataFrame([(1, 5), (None, 6), (None, 7)], "id INT, x INT")
    assert loads.sync(spark, stored, f"{tmp_path}/sync", "a", ["id"]) == 1
    assert loads.rejected(spark, f"{tmp_path}/sync") == 2
    assert loads.sync(spark, stored.where("id = 1"), f"{tmp_path}/sync", "b", ["id"]) == 0
    assert loads.rejected(spark, f"{tmp_path}/sync") == 0


@pytest.mark.parametrize("batch_date", [d(3), "2024-01-03", dt.datetime(2024, 1, 3, 0, 0)])
def test_an_empty_day_of_any_date_type_drops_its_slice(spark, tmp_path, batch_date):
    ddl, path = "id INT, batch_date DATE", f"{tmp_path}/table"
    staged = spark.createDataFrame([(1, d(3)), (2, d(4))], ddl)
    for day in (d(3), d(4)):
        loads.load_slice(spark, staged, path, day, ddl)
    assert loads.load_slice(spark, staged.where("id = 2"), path, batch_date, ddl) == 0
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [2]


def test_a_slice_that_cannot_be_removed_is_an_error(spark, tmp_path, monkeypatch):
    class Files:
        def delete(self, *_):
            return False

        def exists(self, _):
            return True

    class Folder:
        def getFileSystem(self, _):
            return Files()

        def toString(self):
            return "day=1"

    monkeypatch.setattr(tables, "_folders", lambda *_: [("1", Folder())])
    with pytest.raises(OSError):
        tables.drop_slices(spark, str(tmp_path), "day", lambda _: True)
