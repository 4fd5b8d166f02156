"""Loads between stores: incremental export, slice load, audit trail."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill import schemas
from tidemill.functions.numeric import number_or
from tidemill.operators.merge import has_key, mark, merge_into, stored_rows
from tidemill.operators.quality import has_rows
from tidemill.sinks.tables import Slice, conform, counted, drop_slices, read_slices, replace_slice, slices_of
from tidemill.sources.tables import increment, slice_of


def coerce_numbers(df: DataFrame, whole: Sequence[str] = (), real: Sequence[str] = ()) -> DataFrame:
    """Numeric columns that may arrive as text; what is no number becomes 0."""
    present = set(df.columns)
    casts = {c: number_or(c, 0, "int") for c in whole if c in present}
    casts |= {c: number_or(c, 0.0) for c in real if c in present}
    return df.withColumns(casts) if casts else df


def export_increment(
    stored: DataFrame,
    path: str,
    run_id: str,
    keys: Sequence[str],
    time_col: str,
    synced: str = "synced",
    whole: Sequence[str] = (),
    real: Sequence[str] = (),
    **selection,
) -> DataFrame | None:
    """Copy the rows not yet exported to ``path`` and return ``stored`` with
    exactly those rows marked, or None when there is nothing to do.

    The export is a slice of its own (``run_id``): a repeated run replaces it.
    """
    new = increment(stored, time_col, keys[0], synced=synced, **selection)
    if not has_rows(new):
        return None
    export = coerce_numbers(new.drop(synced), whole, real).withColumn("run_id", F.lit(run_id))
    replace_slice(export, path, ["run_id"], [time_col], one_slice=True)
    exported = stored.sparkSession.read.parquet(path).where(F.col("run_id") == run_id)
    return mark(stored, exported, keys, synced)


def sync(spark: SparkSession, stored: DataFrame, folder: str, run_id: str, keys: Sequence[str], sort_by: Sequence[str] = ()) -> int:
    """Exports every row that no other run has exported, and stores which ones; returns their number.

    For tables that are not split by day and batch (see ``sync_slices``).  The marks are a narrow
    table of their own, a slice per run: ``stored`` is not rewritten, rows that arrive late are
    found by their absence, and a repeated run replaces its slices.  Rows without a key cannot be
    marked; they are kept apart under ``rejects``, replaced by every run, which ``rejected`` counts.
    """
    export, marks = f"{folder}/export", f"{folder}/marks"
    keyless = stored.where(~has_key(keys)).withColumn("run_id", F.lit(run_id))
    keyless.write.mode("overwrite").parquet(f"{folder}/rejects")
    rows = stored.where(has_key(keys))
    known = stored_rows(spark, marks)
    if known is not None:
        rows = rows.join(known.where(F.col("run_id") != run_id).select(*keys).distinct(), list(keys), "left_anti")
    rows = rows.withColumn("run_id", F.lit(run_id))
    written = counted(lambda seen: replace_slice(rows, export, ["run_id"], sort_by, one_slice=True, seen=seen))["rows"]
    if written:
        exported = spark.read.parquet(export).where(F.col("run_id") == run_id)
        replace_slice(exported.select(*keys, "run_id"), marks, ["run_id"], one_slice=True)
    else:
        for path in (export, marks):
            drop_slices(spark, path, "run_id", lambda run: run == run_id)
    return written


def pending_slices(
    spark: SparkSession, source: str, folder: str, by: dict[str, str], oldest: str | None = None
) -> list[Slice]:
    """The slices of a table that no run has exported as they are now.

    Marks say, per source day, which of its slices were exported and when those had changed
    last.  Rows that arrive late lie in a new slice of an old day; a slice written again has
    changed since.  With ``oldest`` earlier days are not looked at, neither they nor their
    marks; days are compared as text, and rows without a day are always looked at.
    """
    days = (lambda day: True) if oldest is None else (lambda day: day is None or day >= oldest)
    found = slices_of(spark, source, list(by), days)
    marks = slices_of(spark, f"{folder}/marks", ["day"], days)
    if not found or not marks:
        return found
    known = read_slices(spark, f"{folder}/marks", marks, {}).groupBy("slice").agg(F.max("changed").alias("changed"))
    done = {r["slice"]: r["changed"] for r in known.collect()}  # one short row per slice looked at
    return [x for x in found if done.get(_slice_key(x)) != x.changed]


def _slice_key(x: Slice) -> str:
    return "/".join("" if v is None else f"={v}" for v in x.values)


def sync_slices(
    spark: SparkSession,
    source: str,
    folder: str,
    run_id: str,
    by: dict[str, str],
    sort_by: Sequence[str] = (),
    oldest: str | None = None,
) -> dict[str, int]:
    """Exports the slices that are new or have changed; returns the numbers of rows and slices.

    ``by`` are the columns that split the source, a day first, with their types.  A run lists
    folders and reads new slices only, so it costs what has arrived, however much is stored.
    The export is split alike: a slice exported again, after a lost run or a change, replaces
    itself.  Marks are written last and are a slice per source day and run.
    """
    pending = pending_slices(spark, source, folder, by, oldest)
    if not pending:
        return {"rows": 0, "slices": 0}
    rows = read_slices(spark, source, pending, by).withColumn("run_id", F.lit(run_id))
    export = f"{folder}/export"
    written = counted(lambda seen: replace_slice(rows, export, list(by), sort_by, seen=seen))["rows"]
    marks = spark.createDataFrame(
        [(_slice_key(x), x.changed, x.values[0], run_id) for x in pending],
        "slice STRING, changed LONG, day STRING, run_id STRING",
    )
    replace_slice(marks, f"{folder}/marks", ["day", "run_id"])
    return {"rows": written, "slices": len(pending)}


def rejected(spark: SparkSession, folder: str) -> int:
    """The rows without a key that the last ``sync`` met."""
    return spark.read.parquet(f"{folder}/rejects").count()


def high_water_mark(exported: DataFrame, time_col: str, key: str) -> tuple | None:
    """The (time, key) up to which rows are exported, for ``increment(after=...)``."""
    row = exported.agg(F.max(F.struct(time_col, key)).alias("m")).first()["m"]
    return None if row is None else (row[0], row[1])


def load_slice(spark: SparkSession, staged: DataFrame, path: str, batch_date, ddl: str) -> int:
    """Replace one batch_date slice of the warehouse folder; returns its row count.

    A day without rows removes the slice that an earlier load left.
    """
    rows = conform(slice_of(staged, "batch_date", batch_date), ddl)
    written = counted(lambda seen: replace_slice(rows, path, ["batch_date"], one_slice=True, seen=seen))["rows"]
    if not written:
        # The day as the folder's name prints it, whatever kind of date was given.
        day = spark.range(1).select(F.lit(batch_date).cast("date").cast("string")).first()[0]
        drop_slices(spark, path, "batch_date", lambda found: found == day)
    return written


def log_run(
    spark: SparkSession,
    path: str,
    job: str,
    day: dt.date,
    extracted: int,
    staged: int,
    loaded: int,
    logged_at: dt.datetime,
    status: str = "SUCCESS",
) -> None:
    """One audit row per job and day; a rerun of the day updates it."""
    schema = T.StructType.fromDDL(schemas.AUDIT_ROW)
    row = spark.createDataFrame([(job, day, extracted, staged, loaded, status, logged_at)], schema)
    merge_into(spark, path, row, ["dag_id", "execution_date"], ["logged_at"], buckets=1)
