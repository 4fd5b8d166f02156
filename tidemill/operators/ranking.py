"""Ranking over a whole table without one task seeing it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS = 64  # ranges of a doubling of the distance from the least, the greatest, or zero


def _range_of(value: Column, least: Column, greatest: Column) -> list[Column]:
    """The range in which a value lies; ranges are in the order of their values.

    Three measures that never fall when the value rises, each with so many steps for every
    doubling: they are fine near the least value, near zero and near the greatest.
    """

    def steps(x: Column) -> Column:
        # 1075 doublings lie between the smallest double and 1.
        return F.coalesce(F.signum(x) * F.floor((F.log2(F.abs(x)) + F.lit(1075.0)) * F.lit(float(STEPS))), F.lit(0.0))

    return [steps(value - least), steps(value), -steps(greatest - value)]


def global_rank(
    df: DataFrame,
    by: str,
    dense: str | None = None,
    rank: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Add DENSE_RANK and/or RANK over ``by`` descending, NULL last.

    ``weight`` counts a row as that many rows in RANK: ranking per-key rows
    weighted by their row count gives the rank of the underlying rows.

    Only the distinct values with their weights are ranked.  They are cut into ranges by a
    fixed rule between the least and the greatest, so nothing has to run while the plan is
    built and a task that runs again cuts alike; totals per range (at most some hundred
    thousand rows, whatever the table's size) give each range its offset, a window inside the
    range does the rest, and the rows take their value's rank.
    """
    w = F.col(weight) if weight else F.lit(1)
    values = df.groupBy(by).agg(F.sum(w).cast("bigint").alias("rows_here"))
    largest_first = F.col(by).desc_nulls_last()
    value = F.col(by).cast("double")
    finite = F.when(F.abs(value) < F.lit(float("inf")), value)
    ends = values.agg(F.struct(F.min(finite).alias("least"), F.max(finite).alias("greatest"))).scalar()
    place = ["is_given", "is_nan", "from_least", "from_zero", "from_greatest"]
    ranges = [value.isNotNull(), F.coalesce(F.isnan(value), F.lit(False)), *_range_of(value, ends["least"], ends["greatest"])]
    values = values.withColumns(dict(zip(place, ranges)))
    inside = Window.partitionBy(*place).orderBy(largest_first)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumns({
        "value_no": F.row_number().over(inside).cast("bigint"),
        "rows_before": F.coalesce(F.sum("rows_here").over(before), F.lit(0)).cast("bigint"),
    })
    sums = values.groupBy(*place).agg(F.count(F.lit(1)).alias("values_in"), F.sum("rows_here").alias("rows_in"))
    higher = Window.orderBy(*[F.col(c).desc() for c in place]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *place,
        F.coalesce(F.sum("values_in").over(higher), F.lit(0)).alias("values_off"),
        F.coalesce(F.sum("rows_in").over(higher), F.lit(0)).alias("rows_off"),
    )
    values = values.join(offsets, place).select(
        by,
        (F.col("value_no") + F.col("values_off")).alias("value_no"),
        (F.col("rows_before") + F.col("rows_off")).alias("rows_before"),
    )
    out = df.alias("r").join(values.alias("v"), F.col(f"r.{by}").eqNullSafe(F.col(f"v.{by}")))
    extra = []
    if rank:
        extra.append((F.col("v.rows_before") + 1).cast("bigint").alias(rank))
    if dense:
        extra.append(F.col("v.value_no").cast("bigint").alias(dense))
    return out.select("r.*", *extra)


def top(df: DataFrame, k: int, *order) -> DataFrame:
    """The first ``k`` rows in an order that ends with a unique key."""
    return df.orderBy(*order).limit(k)
