"""Rows with a time to live of their own, settled by day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.time import clock
from tidemill.sinks.tables import NO_VALUE, drop_slices, replace_slice

EXPIRES, DAY = "expires_at", "expires_on"


def with_expiry(df: DataFrame, time_col: str, days: int | Column, written_at) -> DataFrame:
    """Rows with the instant at which they end: their time, or where it is missing the time of
    writing, and ``days`` (a number, or a column of a row's own).  NULL days never end."""
    days = F.lit(days) if isinstance(days, int) else days
    begin = F.coalesce(F.col(time_col), clock(written_at).cast(df.schema[time_col].dataType))
    ends = begin + F.make_dt_interval(days.cast("int"))
    return df.withColumns({EXPIRES: ends, DAY: ends.cast("date")})


def store_expiring(df: DataFrame, path: str, slice_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Rows of ``with_expiry`` as slices by the day on which they end, then by ``slice_by``."""
    replace_slice(df, path, [DAY, *slice_by], sort_by)


def alive(df: DataFrame, as_of) -> DataFrame:
    """Rows that have not ended; folders of earlier days are not read."""
    now = clock(as_of)
    endless = F.col(DAY).isNull()
    on_time = (F.col(DAY) >= now.cast("date")) & (F.col(EXPIRES) > now)
    return df.where(on_time | endless).drop(EXPIRES, DAY)


def expire_rows(spark: SparkSession, path: str, today: dt.date) -> list[str]:
    """Removes the rows that ended before ``today``: whole folders, without a rewrite."""
    return drop_slices(spark, path, DAY, lambda day: day != NO_VALUE and day < today.isoformat())
