"""Unique loads, rows that expire, models in order, ranks of odd values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemill.operators.ranking import global_rank
from tidemill.sinks import expiry, models, tables, unique
from tidemill.sinks.models import Model

TODAY = dt.date(2024, 3, 1)


def orders(spark, *rows):
    return spark.createDataFrame(rows, "k INT, v STRING")


def stored(spark, path):
    return sorted(((r["k"], r["v"], r["load_id"]) for r in spark.read.parquet(path).collect()), key=repr)


@pytest.mark.parametrize(
    ("rule", "want"),
    [
        ("ignore", [(1, "a", "one"), (2, "b", "one"), (3, "x", "two"), (None, "n", "one"), (None, "n", "two")]),
        ("replace", [(1, "a", "one"), (2, "y", "two"), (3, "z", "two"), (None, "n", "one"), (None, "n", "two")]),
    ],
)
def test_conflicts_by_rule(spark, tmp_path, rule, want):
    path = str(tmp_path / "t")
    unique.load_unique(spark, path, orders(spark, (1, "a"), (2, "b"), (None, "n")), ["k"], "one", rule)
    second = orders(spark, (2, "y"), (3, "x"), (3, "z"), (None, "n"))
    for _ in range(2):
        unique.load_unique(spark, path, second, ["k"], "two", rule, ["v"])
        assert stored(spark, path) == sorted(want, key=repr)


def test_a_refused_load_leaves_no_trace(spark, tmp_path):
    path = str(tmp_path / "t")
    assert unique.load_unique(spark, path, orders(spark, (1, "a"), (2, "b")), ["k"], "one") == 2
    before = stored(spark, path)
    for rows in ([(2, "x"), (5, "y")], [(7, "x"), (7, "y")]):
        with pytest.raises(unique.KeyConflict):
            unique.load_unique(spark, path, orders(spark, *rows), ["k"], "two")
        assert stored(spark, path) == before
    # The same load again is no conflict with itself, and may have shrunk.
    assert unique.load_unique(spark, path, orders(spark, (1, "c")), ["k"], "one") == 1
    assert stored(spark, path) == [(1, "c", "one")]
    with pytest.raises(ValueError):
        unique.load_unique(spark, path, orders(spark), ["k"], "two", "merge")


def test_a_load_that_loses_all_rows_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    unique.load_unique(spark, path, orders(spark, (1, "a")), ["k"], "one", "replace")
    unique.load_unique(spark, path, orders(spark, (2, "b")), ["k"], "two", "replace")
    unique.load_unique(spark, path, orders(spark, (1, "c"), (3, "d")), ["k"], "three", "replace")
    assert stored(spark, path) == [(1, "c", "three"), (2, "b", "two"), (3, "d", "three")]
    assert unique.load_unique(spark, path, orders(spark, (1, "z")), ["k"], "four", "ignore") == 0


def test_replacing_reads_and_rewrites_touched_loads_only(spark, tmp_path):
    path = tmp_path / "t"
    for load, k in (("one", 1), ("two", 2)):
        unique.load_unique(spark, str(path), orders(spark, (k, load)), ["k"], load, "replace")
    before = sorted(x.name for x in (path / "load_id=one").glob("*.parquet"))
    unique.load_unique(spark, str(path), orders(spark, (2, "new")), ["k"], "three", "replace")
    assert sorted(x.name for x in (path / "load_id=one").glob("*.parquet")) == before
    assert not (path / "load_id=two").exists()


def at(day, hour=0):
    return dt.datetime(2024, 2, day, hour)


def test_rows_end_by_their_own_time_to_live(spark, tmp_path):
    rows = [(1, at(1), 10), (2, at(1), 40), (3, None, 10), (4, None, 2), (5, at(20), None), (6, at(28, 12), 2)]
    df = spark.createDataFrame(rows, "id INT, ts TIMESTAMP_NTZ, days INT")
    path = str(tmp_path / "t")
    expiry.store_expiring(expiry.with_expiry(df, "ts", F.col("days"), "2024-02-25 00:00:00"), path, sort_by=["id"])
    def left(as_of):
        return sorted(r["id"] for r in expiry.alive(spark.read.parquet(path), as_of).collect())
    assert left("2024-03-01 00:00:00") == [2, 3, 5, 6]
    assert left("2024-03-01 12:00:00") == [2, 3, 5]
    assert expiry.expire_rows(spark, path, TODAY) == ["2024-02-11", "2024-02-27"]
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [2, 3, 5, 6]
    assert expiry.expire_rows(spark, path, TODAY) == []
    assert expiry.expire_rows(spark, path, dt.date(2030, 1, 1)) and left(TODAY) == [5]


def test_alive_prunes_days(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, at(i)) for i in range(1, 20)], "id INT, ts TIMESTAMP_NTZ")
    expiry.store_expiring(expiry.with_expiry(df, "ts", 1, "2024-02-01 00:00:00"), path)
    plan = expiry.alive(spark.read.parquet(path), "2024-02-18 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "expires_on" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]


def test_rows_without_a_day_expire_by_when_they_were_written(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, dt.date(2024, 1, 1), at(1)), (2, dt.date(2024, 2, 20), at(1)), (3, None, dt.datetime(2024, 1, 1)), (4, None, at(28)), (5, None, None)]
    df = spark.createDataFrame(rows, "id INT, day DATE, written TIMESTAMP_NTZ")
    tables.replace_slice(df, path, ["day"])
    def ids():
        return sorted(r["id"] for r in spark.read.parquet(path).collect())
    assert tables.expire(spark, path, "day", TODAY) == ["2024-01-01"]
    assert ids() == [2, 3, 4, 5]
    assert tables.expire(spark, path, "day", TODAY, written="written") == [tables.NO_VALUE]
    assert ids() == [2, 4, 5]
    assert tables.expire(spark, path, "day", TODAY, written="written") == []
    tables.replace_slice(df.where("id = 3"), path, ["day"])
    tables.expire(spark, path, "day", TODAY, written="written")
    assert ids() == [2]


def names(found):
    return [m.name for m in found]


def test_models_are_ordered_by_what_they_read():
    given = [
        Model("report", "SELECT * FROM mart JOIN `dim` USING (k) -- FROM later\n WHERE x <> 'from other'"),
        Model("mart", "WITH s AS (SELECT * FROM stage) SELECT * FROM s WHERE k IN (SELECT k FROM raw.events)", "table"),
        Model("dim", lambda s: s.table("stage"), reads=["stage"]),
        Model("stage", "SELECT 1 AS k"),
        Model("later", "SELECT 2 AS k"),
    ]
    assert names(models.in_order(given)) == ["stage", "later", "mart", "dim", "report"]
    assert models.affected(given, ["raw.events"]) == {"raw.events", "mart", "report"}
    assert models.affected(given, ["dim"]) == {"dim", "report"}


def test_cycles_and_names_given_twice_are_errors():
    circle = [Model("a", "SELECT * FROM b"), Model("b", "SELECT * FROM c"), Model("c", "SELECT * FROM a"), Model("d", "SELECT 1")]
    with pytest.raises(ValueError, match="a -> b -> c -> a"):
        models.in_order(circle)
    with pytest.raises(ValueError, match="cycle: me -> me"):
        models.in_order([Model("me", "SELECT * FROM me")])
    with pytest.raises(ValueError, match="twice: x"):
        models.in_order([Model("x", "SELECT 1"), Model("x", "SELECT 2")])


def test_only_what_depends_on_a_change_is_built_again(spark, tmp_path):
    built = []

    def table(name, *reads):
        def build(s):
            built.append(name)
            return s.table(reads[0]) if reads else s.range(3)

        return Model(f"dep_{name}", build, "table", [f"dep_{x}" for x in ()] + list(reads))

    given = [table("c", "dep_b"), table("b", "dep_view"), Model("dep_view", "SELECT * FROM dep_a"), table("a"), table("z")]
    assert models.publish_models(spark, given, str(tmp_path)) == ["dep_a", "dep_z", "dep_view", "dep_b", "dep_c"]
    built.clear()
    assert models.publish_models(spark, given, str(tmp_path), changed=["dep_b"]) == ["dep_b", "dep_c"]
    assert built == ["b", "c"] and spark.table("dep_c").count() == 3


def test_ranks_of_odd_values_and_crowded_ranges(spark):
    values = [math.inf, -math.inf, math.nan, 0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, None, 1.0, 1.0 + 2**-52, -7.5]
    values += [1.7e9 + i for i in range(3000)] + [i * 1e-9 for i in range(500)] + [-1e6 + i / 8 for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values + values[:40]], "v DOUBLE")
    got = global_rank(df, "v", dense="d", rank="r")
    want = spark.sql("SELECT v, dense_rank() OVER (ORDER BY v DESC) d, rank() OVER (ORDER BY v DESC) r FROM {df}", df=df)
    assert got.select("v", "d", "r").exceptAll(want).isEmpty() and got.count() == len(values) + 40
    assert global_rank(df.limit(0), "v", dense="d").collect() == []


def test_a_rank_runs_nothing_while_its_plan_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan only", "")
    try:
        out = global_rank(spark.range(1000), "id", dense="d")
        assert not tracker.getJobIdsForGroup("plan only")
        assert out.count() == 1000
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
