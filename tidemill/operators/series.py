"""Ordered per-key series: lag, returns, moving averages, crossovers.

A window puts one key's rows into one task.  Every series here therefore holds
at most one row per key and calendar period (``per_period`` or an aggregate
ensures it first), so a task sees no more rows than the calendar has periods,
however many raw rows a key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.numeric import change_pct, flag
from tidemill.functions.sums import mean_of_last
from tidemill.operators.dedup import latest_per_key


def per_period(df: DataFrame, key: str, period: str, order: Sequence[str | Column]) -> DataFrame:
    return latest_per_key(df, [key, period], order)


def previous(value: Column | str, key: str, period: str) -> Column:
    """The value of the previous row of the series (not of the previous period)."""
    return F.lag(value, 1).over(Window.partitionBy(key).orderBy(period))


def return_pct(value: str, key: str, period: str, digits: int | None = None) -> Column:
    return change_pct(F.col(value), previous(value, key, period), digits)


def moving_average(value: str, key: str, period: str, rows: int) -> Column:
    """Mean of the last ``rows`` rows, the current one included; short at the start."""
    return mean_of_last(value, rows, key, period)


def crosses_above(fast: str, slow: str, key: str, period: str) -> Column:
    """The fast series is above the slow one and was not in the previous row."""
    now = F.col(fast) > F.col(slow)
    return flag(now & (previous(fast, key, period) <= previous(slow, key, period)))


def prior_period(value: str, key: str, period: str) -> Column:
    """The value of exactly the previous period, NULL across a gap.

    The series holds each period once, so the row before is the only candidate: one
    window instead of a join of the series with itself.
    """
    is_prior = previous(period, key, period) == F.col(period) - 1
    return F.when(is_prior, previous(value, key, period))


def first_and_last(df: DataFrame, key: str, period: str, value: str, first: str, last: str) -> DataFrame:
    """First and last value per key and the number of rows, without a window."""
    return df.groupBy(key).agg(
        F.min_by(value, period).alias(first),
        F.max_by(value, period).alias(last),
        F.count(F.lit(1)).alias("rows"),
    )
