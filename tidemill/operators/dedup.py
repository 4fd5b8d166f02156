"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def orderable(df: DataFrame) -> list[str]:
    """The columns that can be compared."""
    return [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], oldest: bool = False
) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple, or with the least.

    Catalyst turns ``row_number() = 1`` into a group limit on both sides of the
    exchange: every task first reduces its rows to one per key, so a key with a
    large share of all rows is shuffled as one row per task.  NULL orders
    lowest.  Ties are broken by the remaining columns, so the survivor is the
    same when a lost task runs again.
    """
    named = [c for c in order if isinstance(c, str)]
    order = [*order, *[c for c in orderable(df) if c not in keys and c not in named]]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    order = [c.asc_nulls_last() if oldest else c.desc_nulls_last() for c in order] or [F.lit(1)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place_in_key", place).where(F.col("place_in_key") == 1).drop("place_in_key")


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key, the plain ``dropDuplicates``."""
    return df.dropDuplicates(list(keys))


def stream_dedup(
    stream: DataFrame, keys: Sequence[str], time_col: str, delay: str, spread: int = 0
) -> DataFrame:
    """Each key once while its first copy is within ``delay`` of the watermark.

    State holds the keys seen within the delay only, and a batch holds at most
    the intake limit of the source.  For keys that are redelivered very often,
    ``spread`` removes copies within that many random shares of a key first, so
    no task receives all copies; then each key's few survivors are compared.
    """
    marked = stream.withWatermark(time_col, delay)
    if spread:
        shares = marked.withColumn("share", F.floor(F.rand() * spread).cast("int"))
        marked = shares.dropDuplicatesWithinWatermark([*keys, "share"]).drop("share")
    return marked.dropDuplicatesWithinWatermark(list(keys))
