"""Table reads: scans, slices, increments, key ranges.

All conditions are plain comparisons of a column with a literal, so Parquet and
JDBC scans receive them and partitioned folders are pruned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.numeric import not_true
from tidemill.functions.time import clock


def scan(spark: SparkSession, where: str) -> DataFrame:
    """A Parquet folder (anything with a slash) or a catalog table."""
    return spark.read.parquet(where) if "/" in where else spark.table(where)


def scan_external(spark: SparkSession, format: str, options: dict[str, str]) -> DataFrame:
    """A table behind a connector (``jdbc``, a warehouse, a document store).

    For ``jdbc`` at scale give partitionColumn, lowerBound, upperBound and
    numPartitions in ``options``; without them the read is a single task.
    """
    return spark.read.format(format).options(**options).load()


def slice_of(df: DataFrame, column: str, value) -> DataFrame:
    """The rows of one batch slice, e.g. ``batch_date``."""
    return df.where(F.col(column) == F.lit(value))


def increment(
    df: DataFrame,
    time_col: str,
    key: str,
    synced: str | None = None,
    not_before: Column | None = None,
    after: tuple | None = None,
    cap: int | None = None,
) -> DataFrame:
    """Rows that still have to be exported.

    ``synced`` keeps rows whose flag is False or missing.  ``not_before`` is
    an age limit.  ``after`` is a high-water mark (time, key): rows strictly
    behind it in (time, key) order.  It needs no flag, and skips nothing if
    ``time_col`` is the time at which a row was stored; with an event time, rows
    that arrive late lie before the mark and need the flag.
    ``cap`` takes the oldest rows only (those without a time first); without it the
    increment is whole.
    """
    if synced is not None:
        df = df.where(not_true(synced))
    if not_before is not None:
        df = df.where(F.col(time_col) >= not_before)
    if after is not None:
        mark, mark_key = clock(after[0]), F.lit(after[1])
        df = df.where(F.col(time_col) >= mark)
        df = df.where((F.col(time_col) > mark) | (F.col(key) > mark_key))
    return df if cap is None else oldest(df, time_col, key, cap)


def oldest(df: DataFrame, time_col: str, key: str, cap: int) -> DataFrame:
    """The ``cap`` oldest rows in (time, key) order.

    A plain sort-and-limit would keep ``cap`` candidates of every partition and
    merge them in one task.  The hour in which the cap is reached is found from
    hourly counts first (one row per hour), so only rows up to it are sorted.
    Rows without a time come first.
    """
    hours = df.groupBy(F.date_trunc("hour", time_col).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy(F.col("hour").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    last_hour = hours.where(F.col("before") < cap).agg(F.max("hour").alias("hour")).scalar()
    near = df.where(F.col(time_col).isNull() | (F.col(time_col) < last_hour + F.expr("INTERVAL 1 HOUR")))
    return near.orderBy(F.col(time_col).asc_nulls_first(), key).limit(cap)


def find(
    df: DataFrame,
    condition: Column | None = None,
    fields: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Document-store ``find``: filter and projection."""
    if condition is not None:
        df = df.where(condition)
    names = [c for c in (fields or df.columns) if c not in exclude]
    return df.select(*names)


def among(df: DataFrame, column: str, keys: Sequence | DataFrame) -> DataFrame:
    """IN: a short list becomes a pushed filter, a frame of keys a semi join."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(column), column, "left_semi")
    return df.where(F.col(column).isin(list(keys)))


def key_history(
    df: DataFrame, key_col: str, key, time_col: str, start: Column, limit: int | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    """One key's rows from ``start`` on, newest first; ``ties`` order rows of the same time."""
    rows = df.where((F.col(key_col) == F.lit(key)) & (F.col(time_col) >= start))
    rows = rows.orderBy(F.col(time_col).desc(), *[F.col(c).desc_nulls_last() for c in ties])
    return rows if limit is None else rows.limit(limit)
