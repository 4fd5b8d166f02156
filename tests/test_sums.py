"""Order-free sums and moments against exact fractions."""

import datetime as dt
import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemill.functions import sums
from tidemill.operators import rollups
from tidemill.plans import readings as plan
from tidemill.registered.base import AS_OF, READINGS

NAN, INF = float("nan"), float("inf")


def measured(df):
    """total, mean and deviation of x, correlation of x and y per k."""
    moments = {"t": sums.total("x"), "m": sums.mean("x"), "s": sums.stddev("x")}
    found = sums.correlations(sums.with_products(df, ("x", "x")), ["k"], "x", "y", "c", **moments).collect()
    return {r["k"]: (r["t"], r["m"], r["s"], r["c"]) for r in found}


def wanted(rows):
    x = [Fraction(v) for v, _ in rows if v is not None]
    total = float(sum(x)) if x else None
    mean = total / len(x) if x else None
    about = sum(x) / len(x) if x else None
    spread = math.sqrt(sum((v - about) ** 2 for v in x) / (len(x) - 1)) if len(x) > 1 else None
    pairs = [(Fraction(a), Fraction(b)) for a, b in rows if a is not None and b is not None]
    if not pairs:
        return total, mean, spread, None
    mx, my = (sum(p[i] for p in pairs) / len(pairs) for i in (0, 1))
    xx, yy = sum((a - mx) ** 2 for a, _ in pairs), sum((b - my) ** 2 for _, b in pairs)
    xy = sum((a - mx) * (b - my) for a, b in pairs)
    corr = float(xy) / (math.sqrt(xx) * math.sqrt(yy)) if xx and yy else None
    return total, mean, spread, corr


def groups():
    rng = random.Random(1)
    value = {
        "all sizes": lambda: rng.uniform(-1, 1) * 10.0 ** rng.randint(-15, 15),
        "prices": lambda: round(rng.uniform(0, 500), 2),
        "far from zero": lambda: 1e8 + rng.random(),
        "tiny": lambda: rng.uniform(-1, 1) * 1e-13,
        "constant": lambda: 2.5,
    }
    out = {}
    for name, draw in value.items():
        x = [draw() for _ in range(60)]
        out[name] = [(v if i % 7 else None, v * 0.5 + draw() if i % 5 else None) for i, v in enumerate(x)]
    out["cancelled"] = [(1e15, 1.0), (1e-15, 2.0), (-1e15, 5.0)]
    out["below a decimal"] = [(1e-13, 1.0), (3e-13, 2.0)]
    out["three"], out["one"], out["none"] = [(0.1, 1.0), (0.2, 3.0), (0.3, 2.0)], [(4.0, 4.0)], [(None, 1.0)]
    out["many"] = [(9e11, 1.0)] * 300
    return out


def frame(spark, given, seed=None):
    rows = [(k, *pair) for k, pairs in given.items() for pair in pairs]
    if seed is not None:
        random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "k STRING, x DOUBLE, y DOUBLE").repartition(1 if seed is None else 3 + seed)


def test_moments_are_exact_and_do_not_depend_on_order(spark):
    given = groups()
    found = measured(frame(spark, given))
    for k, rows in given.items():
        total, mean, spread, corr = wanted(rows)
        assert found[k][:2] == (total, mean), k
        for got, want in zip(found[k][2:], (spread, corr)):
            assert got == (None if want is None else pytest.approx(want, rel=1e-14)), k
    assert found["below a decimal"][1] == 2e-13
    for seed in range(2):
        assert measured(frame(spark, given, seed)) == found


def test_values_outside_the_bins_count(spark):
    given = {"nan": [(NAN, 1.0), (2.0, 2.0)], "inf": [(INF, 1.0), (2.0, 2.0)], "large": [(1e300, 1.0), (5.0, 2.0), (-1e300, 3.0)]}
    found = measured(frame(spark, given))
    assert all(math.isnan(v) for v in found["nan"])
    assert found["inf"][:2] == (INF, INF) and math.isnan(found["inf"][2])
    assert found["large"][:2] == (5.0, 5.0 / 3)
    small = frame(spark, {"s": [(1e-40, 1.0), (2e-40, 1.0)]})
    assert measured(small)["s"][0] == pytest.approx(3e-40)


@given(st.lists(st.floats(-1e15, 1e15), min_size=1, max_size=20))
@settings(max_examples=25, deadline=None)
def test_any_sum_is_rounded_once(spark, values):
    got = spark.createDataFrame([(v,) for v in values], "x DOUBLE").agg(sums.total("x")).first()[0]
    least = min((abs(v) for v in values if v), default=1.0)
    if least > 1e-17:
        assert got == float(sum(map(Fraction, values)))
    else:
        assert got == pytest.approx(math.fsum(values), rel=1e-15, abs=1e-300)


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_states_of_any_batches_merge_to_one_pass(spark, parts):
    given = groups()
    df = frame(spark, given, 1).withColumn("batch", F.pmod(F.hash("x", "y"), F.lit(parts)))
    states = rollups.partial_state(
        df, ["k", "batch"], means=["x"], totals=["y"], spreads=["x"], pairs={"xy": ("x", "y"), "yx": ("y", "x")},
        extremes=["x"], newest={"pair": ["x", "y"]},
    )
    twice = rollups.merge_state(states.withColumn("half", F.col("batch") % 2), ["k", "half"])
    merged = rollups.merge_state(twice, ["k"])
    found = merged.select(
        "k", rollups.state_total("x"), rollups.state_mean("x"), rollups.state_stddev("x"), rollups.state_correlation("xy"),
        rollups.state_correlation("yx"), "hi_pair.x", "n_rows",
    )
    once = measured(df)
    for k, total, mean, spread, corr, back, top, rows in found.collect():
        assert (total, mean, spread, corr) == once[k] and back == corr, k
        assert top == max((v for v, _ in given[k] if v is not None), default=None) and rows == len(given[k])


@pytest.mark.parametrize("as_of", [AS_OF, "2024-01-30 12:20:00", dt.datetime(2024, 1, 15, 0, 59, 59), "2024-01-01 00:30:00"])
def test_stored_hours_give_the_raw_baseline(spark, sf, as_of):
    """Also where the baseline's ends lie inside hours and rows lack a time."""
    rows = READINGS.df(spark, sf)
    extra = rows.limit(3).withColumns({"event_time": F.lit(None).cast("timestamp_ntz"), "batch_id": F.lit(9)})
    rows = rows.unionByName(extra)
    states = [plan.sensor_hour_state(rows.where(F.col("batch_id") == b)) for b in (0, 1, 2, 3, 9)]
    found = plan.anomaly_vs_stored_baseline(rollups.union_all(*states), rows, as_of)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plan.anomaly_vs_baseline(rows, as_of).collect()))
