"""Time columns: parsing, buckets, relative windows.  The clock is an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock(as_of: dt.datetime | dt.date | str | Column) -> Column:
    """``as_of`` as a Column; a zone-free literal, so plans are reproducible."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.date) and not isinstance(as_of, dt.datetime):
        return F.lit(as_of)
    return F.lit(str(as_of)).cast("timestamp_ntz")


def before(as_of, amount: str) -> Column:
    """The instant ``amount`` (such as ``48 HOUR``) before ``as_of``."""
    return clock(as_of) - F.expr(f"INTERVAL {amount}")


def since(time_col: str, as_of, amount: str) -> Column:
    """Sargable relative window: the bound folds to a literal the scan can use."""
    return F.col(time_col) >= before(as_of, amount)


def on_day(time_col: str, as_of) -> Column:
    """The calendar day of ``as_of``, written as a range so that it is pushed down."""
    day = F.date_trunc("day", clock(as_of)).cast("timestamp_ntz")
    return (F.col(time_col) >= day) & (F.col(time_col) < day + F.expr("INTERVAL 1 DAY"))


def since_day(time_col: str, as_of, days: int) -> Column:
    """Calendar days from ``days`` before the day of ``as_of`` on."""
    day = F.date_trunc("day", clock(as_of)).cast("timestamp_ntz")
    return F.col(time_col) >= day - F.expr(f"INTERVAL {days} DAY")


def from_date(date_col: str, as_of, days: int) -> Column:
    """Like ``since_day`` for a DATE column; the bound folds to a date literal."""
    return F.col(date_col) >= F.date_sub(clock(as_of).cast("date"), days)


def hour_of(c: str) -> Column:
    """Start of the hour, in the zone-free type of a stored bucket."""
    return F.date_trunc("hour", F.col(c)).cast("timestamp_ntz")


def week_of(c: str) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", F.col(c)).cast("date")


def parse_time(c: str) -> Column:
    """Timestamp of ISO text, NULL for text that is none."""
    return F.try_to_timestamp(F.col(c))


def parse_date(c: str) -> Column:
    """Date of ISO text (a time part is cut off), NULL for text that is none."""
    return F.col(c).try_cast("date")


def age_days(created: str, as_of) -> Column:
    return F.datediff(clock(as_of).cast("date"), F.col(created).cast("date"))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole elapsed minutes."""
    return F.timestamp_diff("MINUTE", start, end)


def from_epoch(seconds: Column | None = None, millis: Column | None = None) -> Column:
    return F.timestamp_seconds(seconds) if seconds is not None else F.timestamp_millis(millis)


def iso_hour(c: str) -> Column:
    """Hour bucket as ISO text, e.g. 2024-01-01T05:00:00Z."""
    return F.date_format(F.col(c), "yyyy-MM-dd'T'HH:00:00'Z'")
