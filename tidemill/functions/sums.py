"""Sums, means and second moments of doubles that do not depend on the order of rows.

A sum of doubles changes its last digits with the order in which partitions arrive, so a
retried task may change a result.  Here a double is cut into bins of 22 bits at fixed
places: each bin holds a small whole number, the bins add up to the double exactly, and
whole numbers add up exactly in any order.  A LONG holds the bin's sum of 2^41 rows.  The
state of a sum is its bins and a remainder, so states of any batches merge by adding.

Squares and products enter as the rounded product and its error, which together are exact.
Spread, variance and correlation come from the three sums in twice the usual precision, so a
mean that is large against the spread costs no digits.

The expressions are SQL texts, which the session parses at once; column by column they would
take a thousand calls.

What lies outside the bins adds up as doubles in the remainder: NaN and infinities, values
(or factors of a product) too large, and the part of a value below the lowest bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 22
REST = "rest"


@dataclass(frozen=True)
class Bins:
    """``count`` bins from 2^``low`` upwards."""

    low: int
    count: int

    @property
    def high(self) -> int:
        return self.low + BITS * self.count

    @property
    def names(self) -> list[str]:
        return [f"b{k}" for k in range(self.count)]


SUMS = Bins(-110, 8)       # all digits of 2^-58 (3e-18) to 2^65
PRODUCTS = Bins(-154, 12)  # all digits of products of 2^-25 (3e-8) to 2^54 (2e16)


def _name(c: str) -> str:
    """A column, or a field of one behind a dot, as SQL names it."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in c.split("."))


def _power(exponent: int) -> str:
    return f"{2.0 ** exponent!r}D"


def _digits(x: str, bins: Bins) -> list[str]:
    """The whole numbers of each bin, as doubles; each is the nearest that leaves a small rest."""
    places = [f"rint({x} * {_power(-(bins.low + BITS * k))})" for k in range(bins.count)]
    above = [f" - {p} * {_power(BITS)}" for p in places[1:]]
    return [f"({p}{a})" for p, a in zip(places, [*above, ""])]


def _below(x: str, bins: Bins) -> str:
    """What the bins leave over."""
    return f"({x} - rint({x} * {_power(-bins.low)}) * {_power(bins.low)})"


def value_parts(c: str) -> list[str]:
    """Bins and remainder of a column's value, to be summed; NULL of NULL."""
    x = f"CAST({_name(c)} AS DOUBLE)"
    inside = f"abs({x}) < {_power(SUMS.high - 1)}"
    fits = f"if({inside}, {x}, NULL)"
    return [f"CAST({d} AS BIGINT)" for d in _digits(fits, SUMS)] + [f"if({inside}, {_below(x, SUMS)}, {x})"]


def _product_names(a: str, b: str) -> list[str]:
    a, b = sorted((a, b))
    return [f"{a}*{b}{part}" for part in ("", " error", " outside")]


def _rounded_product(a: str, b: str) -> tuple[str, str]:
    """The product and its rounding error, from halves of the digits."""

    def halves(v: str) -> tuple[str, str]:
        shifted = f"{v} * 134217729D"  # 2^27 + 1
        upper = f"({shifted} - ({shifted} - {v}))"
        return upper, f"({v} - {upper})"

    (ah, al), (bh, bl) = halves(a), halves(b)
    return f"({a} * {b})", f"(((({ah} * {bh} - {a} * {b}) + {ah} * {bl}) + {al} * {bh}) + {al} * {bl})"


def with_products(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """The frame with the products of pairs of columns, as second moments need them.

    Columns of their own, so that a row's product is computed once for all its bins.
    """
    columns = {}
    limit = _power(PRODUCTS.high // 2 - 1)
    for a, b in sorted({tuple(sorted(pair)) for pair in pairs}):
        x, y = (f"CAST({_name(c)} AS DOUBLE)" for c in (a, b))
        inside = f"(abs({x}) < {limit} AND abs({y}) < {limit})"
        product, error = _rounded_product(x, y)
        values = [f"if({inside}, {product}, NULL)", f"if({inside}, {error}, NULL)", f"if({inside}, NULL, {x} * {y})"]
        columns |= dict(zip(_product_names(a, b), map(F.expr, values)))
    return df.withColumns(columns)


def product_parts(a: str, b: str) -> list[str]:
    """Bins and remainder of the product of two columns, from ``with_products``."""
    product, error, outside = map(_name, _product_names(a, b))
    both = zip(_digits(product, PRODUCTS), _digits(error, PRODUCTS))
    rest = f"{_below(product, PRODUCTS)} + {_below(error, PRODUCTS)}"
    return [f"CAST({m} + {n} AS BIGINT)" for m, n in both] + [f"coalesce({outside}, {rest})"]


def _state(parts: Sequence[str], bins: Bins) -> str:
    fields = ", ".join(f"'{name}', sum({part})" for part, name in zip(parts, [*bins.names, REST]))
    return f"named_struct({fields})"


def value_state(c: str) -> Column:
    """One struct of summed bins and remainder: the mergeable state of a sum."""
    return F.expr(_state(value_parts(c), SUMS))


def product_state(a: str, b: str) -> Column:
    """The state of a sum of products, from ``with_products``."""
    return F.expr(_state(product_parts(a, b), PRODUCTS))


def merged(name: str, bins: Bins) -> Column:
    """The state of all rows' states in a column."""
    return F.expr(_state([f"{_name(name)}.{part}" for part in [*bins.names, REST]], bins))


def _short(parts: Sequence[str], shape: Bins) -> tuple[str, list[str]]:
    """Whether a sum is short (few rows of usual size), and the doubles that then make it, from the highest.

    Neighbouring bins of a short sum are one double, so that nothing has to be carried.
    """
    *bins, rest = parts
    usual = [2, 3, 4, 5] if shape == SUMS else [2, 3, 4, 5, 6, 7]
    limit = (1 << 30) - 1
    tests = [f"{rest} = 0D"] + [
        f"{b} BETWEEN -{limit}L AND {limit}L" if k in usual else f"{b} = 0L" for k, b in enumerate(bins)
    ]
    doubles = [
        f"(CAST({bins[k + 1]} * {1 << BITS}L + {bins[k]} AS DOUBLE) * {_power(shape.low + BITS * k)})" for k in usual[::2]
    ]
    return " AND ".join(tests), doubles[::-1]


def _folded(parts: Sequence[str], shape: Bins) -> str:
    """Summed bins and remainder as a struct of two doubles, high and low, whose sum they are.

    NULL if nothing was added.
    """
    short, (a, b, *more) = _short(parts, shape)
    # The error of a sum of two doubles is a double.
    error = f"({a} - (({a} + {b}) - (({a} + {b}) - {a}))) + ({b} - (({a} + {b}) - {a}))"
    low = " + ".join([error, *more])
    return f"if({short}, named_struct('hi', {a} + {b}, 'lo', {low}), {_carried(parts, shape)})"


def _carried(parts: Sequence[str], shape: Bins) -> str:
    """As ``_folded``, of any sum.  Bins are brought to their nearest digit, from the lowest up: the
    first digit then outweighs the others."""
    *bins, rest = parts
    whole = "(b + s.carry)"
    carry = f"shiftright({whole} + {1 << (BITS - 1)}L, {BITS})"
    digit = f"CAST({whole} - shiftleft({carry}, {BITS}) AS DOUBLE)"
    unit, scale, top = _power(-BITS), _power(shape.high), "CAST(s.carry AS DOUBLE)"
    return f"""if({rest} IS NULL, NULL, aggregate(
        array({", ".join(f"coalesce({b}, 0L)" for b in bins)}),
        named_struct('carry', 0L, 'hi', 0D, 'lo', 0D),
        (s, b) -> named_struct('carry', {carry}, 'hi', ({digit} + s.hi) * {unit},
            'lo', (s.lo + (s.hi - (({digit} + s.hi) - {digit}))) * {unit}),
        s -> named_struct('hi', ({top} + s.hi) * {scale},
            'lo', (s.lo + (s.hi - (({top} + s.hi) - {top}))) * {scale} + {rest})))"""


def _folded_state(state: str, shape: Bins) -> str:
    return _folded(_parts_of(state, shape), shape)


def _number(parts: Sequence[str]) -> str:
    short, (a, b) = _short(parts, SUMS)
    return f"if({short}, {a} + {b}, transform(array({_carried(parts, SUMS)}), p -> p.hi + p.lo)[0])"


def _parts_of(state: str, shape: Bins) -> list[str]:
    return [f"{state}.{x}" for x in [*shape.names, REST]]


def total_of(state: str) -> Column:
    """The sum that a column of states holds."""
    return F.expr(_number(_parts_of(_name(state), SUMS)))


def _total(c: str, over: str = "") -> str:
    return _number([f"sum({part}){over}" for part in value_parts(c)])


def total(c: str) -> Column:
    """Order-free sum of a column as a double; NULL of no value."""
    return F.expr(_total(c))


def mean(c: str) -> Column:
    """The order-free sum over the count of values that are not NULL."""
    return F.expr(f"try_divide({_total(c)}, count({_name(c)}))")


def mean_of_last(c: str, rows: int, key: str, order: str) -> Column:
    """The mean of a key's last ``rows`` rows in an order, the current one included."""
    over = f" OVER (PARTITION BY {_name(key)} ORDER BY {_name(order)} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return F.expr(f"try_divide({_total(c, over)}, count({_name(c)}){over})")


def _deviations(n: str, x: str, y: str, xy: str) -> str:
    """n times the sum of products of deviations: n * sum(xy) - sum(x) * sum(y), of pairs of doubles."""
    first, first_error = _rounded_product("v.n", "v.xy.hi")
    other, given = ("v.x", "") if x == y else ("v.y", f", 'y', {y}")
    second, second_error = _rounded_product("v.x.hi", f"{other}.hi")
    small = f"({first_error} + v.n * v.xy.lo) - ({second_error} + v.x.hi * {other}.lo + v.x.lo * {other}.hi)"
    given = f"named_struct('n', CAST({n} AS DOUBLE), 'x', {x}{given}, 'xy', {xy})"
    return f"transform(array({given}), v -> ({first} - {second}) + ({small}))[0]"


def _variance(n: str, x: str, xx: str) -> str:
    of = f"CAST({n} AS DOUBLE)"
    return f"try_divide(greatest({_deviations(n, x, x, xx)}, 0D), {of} * ({of} - 1D))"


def stddev_of(n: str, x: str, xx: str) -> Column:
    """The sample deviation from a column of counts and those of the states of sums and squares."""
    return F.expr(f"sqrt({_variance(_name(n), _folded_state(_name(x), SUMS), _folded_state(_name(xx), PRODUCTS))})")


def stddev(c: str) -> Column:
    """Order-free sample deviation; NULL for fewer than two values.  Needs ``with_products(df, (c, c))``."""
    x, xx = ([f"sum({part})" for part in parts] for parts in (value_parts(c), product_parts(c, c)))
    return F.expr(f"sqrt({_variance(f'count({_name(c)})', _folded(x, SUMS), _folded(xx, PRODUCTS))})")


_PAIRS = {"xx": ("x", "x"), "yy": ("y", "y"), "xy": ("x", "y")}
PAIR_STATES = ("n", "x", "y", *_PAIRS)


def of_pairs(df: DataFrame, x: str, y: str, pair: str = "pair") -> DataFrame:
    """The frame with ``<pair>_x`` and ``<pair>_y``, the two columns where both are given, and their products."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    pairs = df.withColumns({f"{pair}_{k}": F.when(both, F.col(c).cast("double")) for k, c in (("x", x), ("y", y))})
    return with_products(pairs, *[(f"{pair}_{a}", f"{pair}_{b}") for a, b in _PAIRS.values()])


def pair_states(pair: str = "pair") -> dict[str, Column]:
    """The states that a correlation needs, of a frame from ``of_pairs``, by name."""
    states = {"n": F.count(f"{pair}_x")} | {k: value_state(f"{pair}_{k}") for k in ("x", "y")}
    return states | {k: product_state(f"{pair}_{a}", f"{pair}_{b}") for k, (a, b) in _PAIRS.items()}


def merged_pairs(names: Mapping[str, str]) -> dict[str, Column]:
    """The states of all rows' pair states; ``names`` says which column holds which."""
    states = {k: merged(names[k], SUMS) for k in ("x", "y")} | {k: merged(names[k], PRODUCTS) for k in _PAIRS}
    return {"n": F.sum(names["n"])} | states


def correlation_of(names: Mapping[str, str]) -> Column:
    """Pearson correlation from columns of pair states; NULL for a constant series."""
    n = _name(names["n"])
    folds = {k: _folded_state(_name(names[k]), PRODUCTS if k in _PAIRS else SUMS) for k in ("x", "y", *_PAIRS)}
    parts = {k: _deviations(n, folds[a], folds[b], folds[k]) for k, (a, b) in _PAIRS.items()}
    given = ", ".join(f"'{k}', {v}" for k, v in parts.items())
    raw = f"transform(array(named_struct({given})), d -> try_divide(d.xy, sqrt(greatest(d.xx, 0D)) * sqrt(greatest(d.yy, 0D))))[0]"
    # Rounding may go past the ends; NaN stays.
    return F.expr(f"transform(array({raw}), r -> if(isnan(r) OR abs(r) <= 1, r, signum(r)))[0]")


def correlations(df: DataFrame, keys: Sequence[str], x: str, y: str, name: str, **measures: Column) -> DataFrame:
    """Per key the order-free correlation of the complete pairs, with other measures."""
    states = [v.alias(f"pairs_{k}") for k, v in pair_states().items()]
    named = {k: f"pairs_{k}" for k in PAIR_STATES}
    out = of_pairs(df, x, y).groupBy(*keys).agg(*states, *[m.alias(k) for k, m in measures.items()])
    return out.withColumn(name, correlation_of(named)).select(*keys, name, *measures)
