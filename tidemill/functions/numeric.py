"""Numeric column helpers: guarded division, bands, flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL when b is 0 (plain ``/`` raises under ANSI mode)."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def percent(a: Column | str, b: Column | str, digits: int | None = None) -> Column:
    out = ratio(a, b) * F.lit(100.0)
    return out if digits is None else F.round(out, digits)


def change_pct(new: Column | str, old: Column | str, digits: int | None = None) -> Column:
    """Percentage change from ``old`` to ``new``."""
    out = ratio(_col(new) - _col(old), old) * F.lit(100.0)
    return out if digits is None else F.round(out, digits)


def share_pct(condition: Column, digits: int | None = None) -> Column:
    """Percentage of the group's rows that satisfy a condition."""
    return percent(F.count_if(condition), F.count(F.lit(1)), digits)


def flag(condition: Column) -> Column:
    """A boolean in which an unknown condition counts as False."""
    return F.when(condition, True).otherwise(False)


def not_true(c: Column | str) -> Column:
    """True for False and for missing."""
    return ~F.coalesce(_col(c), F.lit(False))


def band(c: Column | str, floors: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first (highest) inclusive floor that ``c`` reaches."""
    c = _col(c)
    (floor, label), *rest = floors
    out = F.when(c >= floor, label)
    for floor, label in rest:
        out = out.when(c >= floor, label)
    return out.otherwise(otherwise)


def z_score(x: Column | str, center: Column | str, spread: Column | str) -> Column:
    return ratio(_col(x) - _col(center), spread)


def outlier(x: Column | str, center: Column | str, spread: Column | str, limit: float = 2.0) -> Column:
    """|x - center| > limit * spread, with a spread of 1 where it is NULL or 0."""
    width = F.coalesce(F.nullif(_col(spread), F.lit(0.0)), F.lit(1.0))
    return flag(F.abs(_col(x) - _col(center)) > F.lit(limit) * width)


def weighted(terms: Sequence[tuple[Column | str, float]], missing: float | None = None) -> Column:
    """Linear score; ``missing`` replaces NULL inputs when given."""
    parts = []
    for c, weight in terms:
        c = _col(c)
        if missing is not None:
            c = F.coalesce(c, F.lit(missing))
        parts.append(c * F.lit(weight))
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out


def number_or(c: Column | str, default: float | int, kind: str = "double") -> Column:
    """Numeric value of a possibly textual column, ``default`` where it has none."""
    value = _col(c).cast("string").try_cast("double")
    value = F.when(F.isnan(value), None).otherwise(value)
    if kind != "double":
        value = value.try_cast(kind)
    return F.coalesce(value, F.lit(default).cast(kind))


# -- statistics -------------------------------------------------------------


def annualised(daily: Column, days: int = 365) -> Column:
    return daily * F.sqrt(F.lit(days))
