"""Time roll-ups and mergeable partial aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import sums


def rollup(df: DataFrame, keys: Sequence[Column | str], **measures: Column) -> DataFrame:
    """``groupBy(keys).agg(measures)`` with the measures named by keyword."""
    return df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])


def partial_state(
    df: DataFrame,
    keys: Sequence[Column | str],
    means: Sequence[str] = (),
    totals: Sequence[str] = (),
    extremes: Sequence[str] = (),
    spreads: Sequence[str] = (),
    pairs: Mapping[str, tuple[str, str]] | None = None,
    newest: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Mergeable state per key: row count and, per column, count, sums, squares, min, max.

    ``spreads`` are columns whose deviation is asked for, ``pairs`` names pairs of columns
    whose correlation is, and ``newest`` names tuples of columns of which the greatest is kept.
    Sums are whole numbers in bins (see ``sums``), so merging the states of any batches in any
    order gives exactly the result of one pass.
    """
    state = [F.count(F.lit(1)).alias("n_rows")]
    state += [F.count(c).alias(f"n_{c}") for c in dict.fromkeys([*means, *spreads])]
    state += [sums.value_state(c).alias(f"sum_{c}") for c in dict.fromkeys([*means, *totals, *spreads])]
    state += [sums.product_state(c, c).alias(f"sq_{c}") for c in spreads]
    state += [agg(c).alias(f"{name}_{c}") for c in extremes for name, agg in (("lo", F.min), ("hi", F.max))]
    state += [F.max(F.struct(*of)).alias(f"hi_{name}") for name, of in (newest or {}).items()]
    if spreads:
        df = sums.with_products(df, *[(c, c) for c in spreads])
    for name, (x, y) in (pairs or {}).items():
        df = sums.of_pairs(df, x, y, name)
        state.append(_struct(sums.pair_states(name)).alias(f"co_{name}"))
    return df.groupBy(*keys).agg(*state)


def _struct(fields: Mapping[str, Column]) -> Column:
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def merge_state(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per key from the states of any number of batches."""

    def merged(c: str) -> Column:
        kind = c.split("_")[0]
        if kind == "co":
            return _struct(sums.merged_pairs({k: f"{c}.{k}" for k in sums.PAIR_STATES}))
        if kind in ("sum", "sq"):
            return sums.merged(c, sums.SUMS if kind == "sum" else sums.PRODUCTS)
        return {"lo": F.min, "hi": F.max}.get(kind, F.sum)(c)

    columns = [c for c in state.columns if c.split("_")[0] in ("n", "sum", "sq", "co", "lo", "hi") and c not in keys]
    return state.groupBy(*keys).agg(*[merged(c).alias(c) for c in columns])


def state_mean(column: str) -> Column:
    """The average of a column from its merged state."""
    return F.try_divide(state_total(column), F.col(f"n_{column}"))


def state_total(column: str) -> Column:
    return sums.total_of(f"sum_{column}")


def state_stddev(column: str) -> Column:
    """The sample deviation of a column from its merged state."""
    return sums.stddev_of(f"n_{column}", f"sum_{column}", f"sq_{column}")


def state_correlation(name: str) -> Column:
    """The correlation of a named pair from its merged state."""
    return sums.correlation_of({k: f"co_{name}.{k}" for k in sums.PAIR_STATES})


def metric_rows(one_row: DataFrame, metrics: dict[str, str], names: tuple[str, str] = ("metric", "value")) -> DataFrame:
    """A one-row frame of measures as (label, text) rows.

    Equivalent to a UNION ALL of one aggregate query per metric, but the table
    is read once.  ``metrics`` maps the label to the measure's column.
    """
    pairs = ", ".join(f"'{label}', CAST(`{column}` AS STRING)" for label, column in metrics.items())
    return one_row.select(F.expr(f"stack({len(metrics)}, {pairs}) AS ({names[0]}, {names[1]})"))


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns a branch lacks are typed NULLs."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
