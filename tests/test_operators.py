import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import quality
from tidemill.operators.dedup import latest_per_key
from tidemill.operators.merge import insert_absent, last_written, mark, merge_into, upsert
from tidemill.operators.ranking import global_rank
from tidemill.operators.rollups import metric_rows, union_all
from tidemill.operators.series import prior_period
from tidemill.plans import indicators, loads, prices, readings
from tidemill.plans.repositories import repository_features
from tidemill.sinks.tables import (
    Target, conform, counted, duplicate_keys, publish_layers, replace_slice, retained,
    upper_names, write_files,
)
from tidemill.sources.logs import Log, bounded_options, stream_options
from tidemill.sources.tables import among, increment, key_history, oldest

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


# -- duplicates -------------------------------------------------------------------


def test_latest_wins_and_null_orders_lowest(spark, rows):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d")], "k INT, t INT, v STRING")
    assert rows(latest_per_key(df, ["k"], ["t", "v"])) == [(1, 5, "b"), (2, None, "d")]


@FEW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9), st.text("ab", max_size=2)), max_size=20))
def test_dedup_is_idempotent(spark, rows, data):
    df = spark.createDataFrame(data, "k INT, t INT, v STRING")
    once = latest_per_key(df, ["k"], ["t", "v"])
    assert rows(once) == rows(latest_per_key(once, ["k"], ["t", "v"]))
    best = {}
    for k, t, v in data:
        best[k] = max(best.get(k, (t, v)), (t, v))
    assert rows(once) == sorted(((k, *tv) for k, tv in best.items()), key=repr)


def test_hot_key_is_reduced_before_the_exchange(spark):
    """One key holds most rows: each task passes on one row for it."""
    df = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    out = latest_per_key(df, ["k"], ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Printed from the top: the partial step is below the exchange.
    assert "WindowGroupLimit" in plan and plan.index("Exchange") < plan.index("Partial")
    assert out.where("k = 0").first()["id"] == 19996


# -- upserts ------------------------------------------------------------------------


BASE = [(1, "a", 1), (2, "b", 2), (3, None, 3)]
SCHEMA = "k INT, s STRING, n INT"


def test_upsert_modes(spark, rows):
    base = spark.createDataFrame(BASE, SCHEMA)
    new = spark.createDataFrame([(1, None, 10), (4, "d", None), (None, "x", 1)], SCHEMA)
    kept = [(1, "a", 10), (2, "b", 2), (3, None, 3), (4, "d", None)]
    assert rows(upsert(base, new, ["k"])) == kept
    assert rows(upsert(base, new, ["k"], null_overwrites=True)) == [(1, None, 10), *kept[1:]]


def test_upsert_keeps_fields_of_either_side(spark, rows):
    base = spark.createDataFrame([(1, "a")], "k INT, s STRING")
    new = spark.createDataFrame([(1, 5), (2, 6)], "k INT, n INT")
    assert rows(upsert(base, new, ["k"], null_overwrites=True)) == [(1, "a", 5), (2, None, 6)]


def test_updates_of_one_key_apply_in_order(spark, rows):
    new = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, 5), (1, 3, None, 6)], "k INT, t INT, s STRING, n INT")
    assert rows(last_written(new, ["k"], ["t"])) == [(1, 3, "a", 6)]
    base = spark.createDataFrame([(1, 0, "z", 1)], new.schema)
    assert rows(upsert(base, new, ["k"], ["t"])) == [(1, 3, "a", 6)]
    assert rows(upsert(base, new, ["k"], ["t"], null_overwrites=True)) == [(1, 3, None, 6)]


def test_late_update_does_not_undo_a_newer_row(spark, rows):
    base = spark.createDataFrame([(1, 9, "new")], "k INT, t INT, v STRING")
    late = spark.createDataFrame([(1, 5, "late")], "k INT, t INT, v STRING")
    assert rows(upsert(base, late, ["k"], ["t"], null_overwrites=True, newest_wins=True)) == [(1, 9, "new")]
    assert rows(upsert(base, late, ["k"], ["t"], null_overwrites=True)) == [(1, 5, "late")]


_text, _number = st.one_of(st.none(), st.text("xy", max_size=2)), st.one_of(st.none(), st.integers(0, 9))
_update = st.tuples(st.integers(1, 4), _text, _number)


@FEW
@given(st.dictionaries(st.integers(1, 4), _update, max_size=4), st.booleans())
def test_upsert_twice_is_upsert_once(spark, rows, updates, null_overwrites):
    base = spark.createDataFrame(BASE, SCHEMA)
    new = spark.createDataFrame([(k, s, n) for k, (_, s, n) in updates.items()], SCHEMA)
    once = upsert(base, new, ["k"], null_overwrites=null_overwrites)
    assert rows(once) == rows(upsert(once, new, ["k"], null_overwrites=null_overwrites))
    want = {k: (s, n) for k, s, n in BASE}
    for k, (_, s, n) in updates.items():
        old = want.get(k, (None, None))
        want[k] = (s, n) if null_overwrites else (s if s is not None else old[0], n if n is not None else old[1])
    assert rows(once) == sorted(((k, *v) for k, v in want.items()), key=repr)


def test_merge_after_an_empty_first_batch(spark, rows, tmp_path):
    new = spark.createDataFrame([(1, "d", "a")], "k INT, d STRING, v STRING")
    for updates in (new.limit(0), new, new.limit(0)):
        merge_into(spark, str(tmp_path / "t"), updates, ["k"], ["v"], slice_by="d")
    assert rows(spark.read.parquet(str(tmp_path / "t")), "k", "v") == [(1, "a")]


def test_a_key_stays_in_its_slice(spark, rows, tmp_path):
    path, kind = str(tmp_path / "t"), "k STRING, v INT, d DATE"
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    merge_into(spark, path, spark.createDataFrame([("a", 1, days[0]), ("b", 1, None)], kind), ["k"], ["v"], slice_by="d")
    later = [("a", 2, None), ("b", 2, days[1]), ("c", 2, days[1]), (None, 2, days[1])]
    merge_into(spark, path, spark.createDataFrame(later, kind), ["k"], ["v"], slice_by="d")
    assert rows(spark.read.parquet(path), "k", "v", "d") == [("a", 2, days[0]), ("b", 2, None), ("c", 2, days[1])]


def test_cap_keeps_rows_without_a_time(spark, rows):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 1, 5)), (3, dt.datetime(2024, 1, 1, 2))], "k INT, t TIMESTAMP_NTZ")
    assert [r.k for r in increment(df, "t", "k", cap=2).collect()] == [1, 3]
    assert [r.k for r in increment(df, "t", "k", cap=1).collect()] == [1]
    assert [r.k for r in increment(df, "t", "k", cap=9).collect()] == [1, 3, 2]


def test_contract_rejects_and_strict_mode(spark, rows):
    df = spark.createDataFrame([("1", "x"), ("y", None), (None, "2")], "a STRING, b STRING")
    out = conform(df, "a INT, b INT, c INT", rejects=True)
    assert rows(out) == [(1, None, None, ["b"]), (None, 2, None, []), (None, None, None, ["a"])]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, "a INT", strict=True).collect()


def test_insert_absent_and_mark(spark, rows):
    base = spark.createDataFrame([(1, None), (2, False), (3, True)], "k INT, synced BOOLEAN")
    new = spark.createDataFrame([(2, True), (7, None)], "k INT, synced BOOLEAN")
    assert rows(insert_absent(base, new, ["k"])) == [(7, None)]
    many = spark.createDataFrame([(8, 3), (8, 2), (None, 4), (1, 5)], "k INT, n INT")
    assert rows(insert_absent(base, many, ["k"], ["n"])) == [(8, 2)]
    done = spark.createDataFrame([(1,), (1,)], "k INT")
    assert rows(mark(base, done, ["k"])) == [(1, True), (2, False), (3, True)]


def test_merge_rewrites_only_touched_slices(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "d1", "a"), (2, "d2", "b"), (3, None, "c")], "k INT, d STRING, v STRING")
    merge_into(spark, path, first, ["k"], ["v"], slice_by="d")
    untouched = sorted(p.name for p in (tmp_path / "t" / "d=d2").glob("*.parquet"))
    second = spark.createDataFrame([(1, "d1", "z"), (3, None, "y"), (4, "d1", "n")], "k INT, d STRING, v STRING")
    for _ in range(2):
        merge_into(spark, path, second, ["k"], ["v"], slice_by="d")
    assert rows(spark.read.parquet(path), "k", "d", "v") == [
        (1, "d1", "z"), (2, "d2", "b"), (3, None, "y"), (4, "d1", "n")]
    assert sorted(p.name for p in (tmp_path / "t" / "d=d2").glob("*.parquet")) == untouched


# -- roll-ups -------------------------------------------------------------------------


@FEW
@given(
    st.lists(
        st.tuples(st.integers(0, 1200), st.integers(0, 2), st.one_of(st.none(), st.integers(-500, 500))),
        min_size=1, max_size=30,
    )
)
def test_states_merge_to_one_pass(spark, rows, data):
    start = dt.datetime(2024, 1, 1)
    records = [(start + dt.timedelta(seconds=s), b, None if v is None else v / 100) for s, b, v in data]
    df = spark.createDataFrame(records, "event_time TIMESTAMP_NTZ, b INT, temperature_c DOUBLE")
    df = df.withColumns(
        {"city": F.lit("c"), "humidity_pct": F.col("temperature_c") / 2, "precipitation_mm": F.lit(0.1)}
    )
    states = union_all(*[readings.window_state(df.where(f"b = {b}")) for b in range(3)])
    assert rows(readings.windows_of_states(states)) == rows(readings.five_minute_windows(df))


def test_reading_on_a_window_boundary(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 5), 1.0)], "event_time TIMESTAMP_NTZ, temperature_c DOUBLE")
    df = df.withColumns(
        {"city": F.lit("c"), "humidity_pct": F.lit(None).cast("double"), "precipitation_mm": F.lit(0.0)}
    )
    row = readings.five_minute_windows(df).first()
    assert row["window_start"] == dt.datetime(2024, 1, 1, 0, 5) and row["avg_humidity_pct"] is None


def test_metric_rows_and_typed_nulls(spark, rows):
    one = spark.createDataFrame([(3, None)], "a INT, b DATE")
    assert rows(metric_rows(one, {"first": "a", "second": "b"})) == [("first", "3"), ("second", None)]
    assert union_all(one, one.select("a")).where("b IS NULL").count() == 2


# -- series -----------------------------------------------------------------------------


def candles(spark, closes, coin="x"):
    data = [(coin, day(i), float(c)) for i, c in enumerate(closes)]
    df = spark.createDataFrame(data, "coin_id STRING, candle_date DATE, close DOUBLE")
    return df.withColumns({"open": F.col("close"), "high": F.col("close"), "low": F.lit(0.0)})


def test_constant_series(spark):
    out = prices.technical_indicators(candles(spark, [5] * 35), day(40)).collect()
    assert {r["ma_7d"] for r in out} == {5.0} and {r["ma_30d"] for r in out} == {5.0}
    assert not any(r["golden_cross"] for r in out)
    assert {r["daily_return_pct"] for r in out} == {None, 0.0} and {r["high_low_ratio"] for r in out} == {None}


@pytest.mark.parametrize(("closes", "signals"), [
    ([10] * 7 + [20] + [20] * 3, [7]),  # rows 1..7 have equal averages, the eighth crosses
    ([10] * 30 + [20] * 3, [30]),
    ([20] * 8 + [10] * 8, []),
])
def test_golden_cross_days(spark, closes, signals):
    out = prices.technical_indicators(candles(spark, closes), day(60))
    crosses = out.where("golden_cross").orderBy("candle_date").collect()
    assert [r["candle_date"] for r in crosses] == [day(i) for i in signals]


@FEW
@given(st.lists(st.integers(1, 10000), min_size=1, max_size=45))
def test_moving_average_by_brute_force(spark, cents):
    closes = [c / 100 for c in cents]
    out = prices.technical_indicators(candles(spark, closes), day(60)).orderBy("candle_date").collect()
    for i, row in enumerate(out):
        for name, n in (("ma_7d", 7), ("ma_30d", 30)):
            part = cents[max(0, i - n + 1): i + 1]
            assert row[name] == pytest.approx(sum(part) / 100 / len(part), abs=1e-6)


def test_lag_is_previous_row_and_calendar_lag_is_not(spark, rows):
    long = spark.createDataFrame(
        [("A", "Aland", "gdp_current_usd", y, v) for y, v in ((2000, 100.0), (2002, 150.0), (2003, 0.0), (2004, 9.0))],
        "country_code STRING, country_name STRING, indicator_name STRING, year INT, value DOUBLE",
    )
    out = indicators.panel(long, dt.date(2005, 1, 1), "2005-01-01").orderBy("year").collect()
    assert [r["gdp_yoy_growth_calc"] for r in out] == [None, 50.0, -100.0, None]
    assert {r["income_group"] for r in out} == {"Low income"} and not any(r["is_digital_ready"] for r in out)
    wide = indicators.widen(long).select("country_code", "year", "gdp_current_usd")
    prior = wide.withColumn("before", prior_period("gdp_current_usd", "country_code", "year"))
    assert rows(prior, "year", "before") == [(2000, None), (2002, None), (2003, 150.0), (2004, 0.0)]


@pytest.mark.parametrize(("share", "ready"), [(60.0, True), (59.99, False), (None, False)])
def test_digital_ready_bound(spark, share, ready):
    long = spark.createDataFrame(
        [("A", "n", "internet_users_pct", 2000, share), ("A", "n", "gdp_current_usd", 2000, 1.0)],
        "country_code STRING, country_name STRING, indicator_name STRING, year INT, value DOUBLE",
    )
    assert indicators.panel(long, dt.date(2005, 1, 1), "2005-01-01").first()["is_digital_ready"] is ready


def test_two_events_of_one_time_have_one_survivor(spark, rows):
    when = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [("x", when, 2.0, "b"), ("x", when, 2.0, "a"), ("x", when, 1.0, "c")],
        "coin_id STRING, event_time TIMESTAMP_NTZ, current_price_usd DOUBLE, symbol STRING",
    )
    assert rows(prices.latest_view(events), "coin_id", "symbol") == [("x", "b")]


def test_rows_past_their_time_to_live_are_dropped(spark, rows):
    now = dt.datetime(2024, 1, 31)
    events = spark.createDataFrame(
        [(1, now - dt.timedelta(days=30)), (2, now - dt.timedelta(days=30, seconds=1))], "id INT, t TIMESTAMP_NTZ"
    )
    assert rows(retained(events, "t", now), "id") == [(1,)]


def test_pivot_takes_the_latest_copy_and_drops_null(spark):
    long = spark.createDataFrame(
        [("A", "n", "gdp_current_usd", 2000, 1.0, "1"), ("A", "n", "gdp_current_usd", 2000, 2.0, "2"),
         ("A", "n", "population_total", 2000, None, "1")],
        "country_code STRING, country_name STRING, indicator_name STRING, year INT, value DOUBLE, ingested_at STRING",
    )
    row = indicators.widen(long).first()
    assert row["gdp_current_usd"] == 2.0 and row["population_total"] is None


# -- ranking ------------------------------------------------------------------------------


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-20, 20)), st.integers(1, 5)), min_size=1, max_size=60),
       st.booleans())
def test_global_rank_by_brute_force(spark, data, split):
    df = spark.createDataFrame([(i, v, w) for i, (v, w) in enumerate(data)], "i INT, v INT, w INT")
    out = global_rank(df, "v", dense="d", rank="r", weight="w")
    key = lambda v: float("-inf") if v is None else v
    for row in out.collect():
        above = [(v, w) for v, w in data if key(v) > key(row["v"])]
        assert row["r"] == 1 + sum(w for _, w in above)
        assert row["d"] == 1 + len({v for v, _ in above})


def test_split_rank_at_size(spark):
    """Many distinct values and one value with a third of the rows."""
    value = F.when(F.col("id") % 3 == 0, 777).otherwise(F.col("id") * 7919 % 50021)
    df = spark.range(60000).select("id", value.alias("v"))
    got = global_rank(df, "v", dense="d", rank="r")
    want = spark.sql(
        "SELECT id, v, dense_rank() OVER (ORDER BY v DESC) d, rank() OVER (ORDER BY v DESC) r FROM {df}", df=df
    )
    assert got.select("id", "v", "d", "r").exceptAll(want.select("id", "v", "d", "r")).isEmpty()


# -- sources and sinks ---------------------------------------------------------------------


def test_log_options():
    log = Log("topic", options={"kafka.bootstrap.servers": "b"}, intake=200)
    assert stream_options(log) == {
        "subscribe": "topic", "startingOffsets": "latest", "kafka.bootstrap.servers": "b",
        "maxOffsetsPerTrigger": "200",
    }
    assert bounded_options(log)["startingOffsets"] == "earliest" and bounded_options(log)["endingOffsets"] == "latest"
    assert stream_options(Log("/x", "text", intake=3)) == {"maxFilesPerTrigger": "3"}


def test_jdbc_target_options():
    target = Target.jdbc("jdbc:postgresql://db/x", "readings", driver="org.postgresql.Driver")
    assert target.format == "jdbc" and target.options["dbtable"] == "readings"
    assert target.options["batchsize"] == "10000"


@pytest.mark.parametrize("cap", [1, 5, 17, 1000])
def test_oldest_by_brute_force(spark, cap):
    start = dt.datetime(2024, 1, 1)
    data = [(i, start + dt.timedelta(minutes=(i * 37) % 400)) for i in range(100)]
    df = spark.createDataFrame(data, "id INT, t TIMESTAMP_NTZ")
    want = sorted(((t, i) for i, t in data))[:cap]
    assert [(r["t"], r["id"]) for r in oldest(df, "t", "id", cap).collect()] == want


def test_increment_null_flag_counts_as_unsynced(spark, rows):
    df = spark.createDataFrame([(1, None), (2, False), (3, True)], "id INT, synced BOOLEAN")
    df = df.withColumn("t", F.current_timestamp())
    assert rows(increment(df, "t", "id", synced="synced"), "id") == [(1,), (2,)]


def test_among_a_list_or_a_table(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k STRING, n INT")
    keys = spark.createDataFrame([("b",), ("b",), ("z",)], "k STRING")
    assert rows(among(df, "k", ["b", "z"])) == rows(among(df, "k", keys)) == [("b", 2)]


def test_key_history_is_newest_first(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "k STRING, t INT")
    assert [r["t"] for r in key_history(df, "k", "a", "t", F.lit(1), 2).collect()] == [4, 3]


def test_slice_replacement_leaves_other_slices(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n INT, batch_date STRING")
    replace_slice(df, path, ["batch_date"])
    replace_slice(spark.createDataFrame([(9, "a")], df.schema), path, ["batch_date"])
    assert rows(spark.read.parquet(path)) == [(2, "b"), (9, "a")]


def test_hot_folder_is_split_over_files(spark, tmp_path):
    """A folder with most of the rows is written by several tasks."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        folder = F.when(F.col("id") % 10 < 8, 0).otherwise(1)
        df = spark.range(0, 200000, 1, 8).select("id", F.rand(1).alias("x"), folder.alias("d"))
        write_files(df, str(tmp_path / "t"), ["d"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "t" / "d=0").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200000


def test_conform_casts_orders_and_fills(spark):
    df = spark.createDataFrame([("12.345", "70000", "x")], "price STRING, small STRING, extra STRING")
    out = conform(df, "small SMALLINT, price DECIMAL(5,2), absent STRING")
    assert out.dtypes == [("small", "smallint"), ("price", "decimal(5,2)"), ("absent", "string")]
    assert [str(v) for v in out.first()] == ["None", "12.35", "None"]


def test_counted_returns_what_was_written(spark, tmp_path):
    out = counted(lambda seen: write_files(spark.range(7), str(tmp_path / "t"), seen=seen), most=F.max("id"))
    assert out == {"rows": 7, "most": 6}


def test_names_and_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id INT, c STRING")
    assert upper_names(df).columns == ["ID", "C"]
    assert rows(duplicate_keys(df, ["id", "c"])) == [(1, "a", 2)]


def test_layers_read_each_other(spark):
    publish_layers(
        spark,
        [("layer_a", lambda s: s.range(3), "view"), ("layer_b", lambda s: s.table("layer_a").where("id > 0"), "view")],
    )
    assert spark.table("layer_b").count() == 2


def test_export_marks_only_what_it_exported(spark, rows, tmp_path):
    start = dt.datetime(2024, 1, 1)
    data = [(i, start + dt.timedelta(hours=i), i % 2 == 0) for i in range(6)]
    df = spark.createDataFrame(data, "id INT, t TIMESTAMP_NTZ, synced BOOLEAN")
    after = loads.export_increment(df, str(tmp_path / "e"), "r1", ["id"], "t", cap=2)
    assert rows(after, "id", "synced") == [(0, True), (1, True), (2, True), (3, True), (4, True), (5, False)]
    exported = spark.read.parquet(str(tmp_path / "e"))
    assert loads.high_water_mark(exported, "t", "id") == (start + dt.timedelta(hours=3), 3)
    assert loads.export_increment(after.where("synced"), str(tmp_path / "e"), "r2", ["id"], "t") is None


def test_repository_edges(spark):
    as_of = dt.datetime(2024, 1, 31)
    data = [
        (1, " Py ", 10, None, "2024-01-31T00:00:00Z", "1"), (1, "old", 99, "MIT", "2024-01-01", "0"),
        (2, "Go", 0, "MIT", "2024-01-01", "1"), (3, "Go", 5, "NONE", "bad", "1"),
    ]
    df = spark.createDataFrame(
        data,
        "repo_id BIGINT, language STRING, stars INT, license STRING, created_at STRING, ingested_at STRING",
    )
    df = df.withColumns({"forks": F.lit(1), "watchers": F.lit(1), "batch_date": F.lit("2024-01-31")})
    out = {r["repo_id"]: r for r in repository_features(df, as_of).collect()}
    assert set(out) == {1, 3}
    young = out[1]
    assert (young["language"], young["license"], young["repo_age_days"]) == ("py", "UNLICENSED", 0)
    assert young["stars_per_day"] == 10.0
    assert out[1]["activity_score"] == 5.5 and out[3]["license"] == "NONE" and out[3]["created_at"] is None
    shifted = {r["repo_id"]: r for r in repository_features(df, as_of, "shift").collect()}
    assert shifted[1]["stars_per_day"] == 10.0 and shifted[3]["stars_per_day"] is None


# -- quality ----------------------------------------------------------------------------------


@pytest.mark.parametrize(("missing", "verdict"), [(6, "incomplete"), (5, "ok"), (4, "ok")])
def test_completeness_gate(spark, missing, verdict):
    now = dt.datetime(2024, 1, 1, 12)
    data = [(now, None if i < missing else 1.0, 1.0) for i in range(100)]
    df = spark.createDataFrame(data, "event_time TIMESTAMP_NTZ, temperature_c DOUBLE, humidity_pct DOUBLE")
    report = quality.reading_quality(df, now)
    assert report.first()["verdict"] == verdict
    if verdict == "incomplete":
        with pytest.raises(quality.QualityError):
            quality.require(report)


@pytest.mark.parametrize(("minutes", "verdict"), [(90, "ok"), (91, "stale")])
def test_freshness_gate(spark, minutes, verdict):
    now = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame(
        [(now - dt.timedelta(minutes=minutes), 1.0, 1.0)],
        "event_time TIMESTAMP_NTZ, temperature_c DOUBLE, humidity_pct DOUBLE",
    )
    assert quality.reading_quality(df, now).first()["verdict"] == verdict


@pytest.mark.parametrize(("unlabelled", "verdict"), [(0, "ok"), (1, "ok"), (2, "unlabelled")])
def test_label_gate(spark, unlabelled, verdict):
    now = dt.datetime(2024, 1, 1, 12)
    data = [(now, None if i < unlabelled else "neutral", 0.0) for i in range(20)]
    df = spark.createDataFrame(data, "ingested_at TIMESTAMP_NTZ, sentiment_label STRING, sentiment_score DOUBLE")
    assert quality.label_quality(df, now).first()["verdict"] == verdict
    assert quality.label_quality(df.limit(0), now).first()["verdict"] == "ok"


def test_reconcile_finds_a_missing_row(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "d STRING")
    out = quality.reconcile(df, df, df.where("d = 'a'"), "d")
    assert rows(out) == [("a", 2, 2, 2, "SUCCESS"), ("b", 1, 1, 0, "MISMATCH")]


def test_sensor_in_two_cities_is_compared_with_both(spark):
    now = dt.datetime(2024, 1, 8)
    data = [("s", c, now - dt.timedelta(hours=h), float(h)) for c in ("x", "y") for h in range(2, 20)]
    data.append(("s", "x", now, 500.0))
    df = spark.createDataFrame(data, "sensor_id STRING, city STRING, event_time TIMESTAMP_NTZ, temperature_c DOUBLE")
    out = readings.anomaly_vs_baseline(df, now).collect()
    assert [(r["baseline_city"], r["status"]) for r in out] == [("x", "ANOMALY"), ("y", "ANOMALY")]


def test_constant_baseline_has_no_score(spark):
    now = dt.datetime(2024, 1, 8)
    data = [("s", "x", now - dt.timedelta(hours=h), 7.0) for h in range(2, 9)] + [("s", "x", now, 9.0)]
    df = spark.createDataFrame(data, "sensor_id STRING, city STRING, event_time TIMESTAMP_NTZ, temperature_c DOUBLE")
    row = readings.anomaly_vs_baseline(df, now).first()
    assert row["z_score"] is None and row["status"] == "NORMAL"
