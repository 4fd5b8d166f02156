import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemill import jobs
from tidemill.operators.dedup import stream_dedup
from tidemill.plans.readings import decode_readings, five_minute_windows, windows_of_states
from tidemill.sinks.tables import Target, replace_slice
from tidemill.sources.logs import Log, open_stream
from tidemill.streaming.jobs import (
    PostBatches, PriceBatches, ReadingBatches, held, run, start, windowed_readings,
)

START = dt.datetime(2024, 1, 1)


def send(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def reading(minute, sensor="s", city="c", temperature=1.0):
    return {"sensor_id": sensor, "city": city, "temperature_c": temperature, "precipitation_mm": 0.5,
            "event_time": (START + dt.timedelta(minutes=minute)).isoformat() + "Z"}


def test_windows_equal_batch_and_late_rows_are_dropped(spark, rows, tmp_path):
    log = tmp_path / "log"
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def take():
        run(windowed_readings(decode_readings(open_stream(spark, Log(str(log), "text")))), checkpoint, path=out)

    kept = [reading(m, temperature=float(m)) for m in range(0, 20)]
    send(log, "1.txt", kept)
    take()
    send(log, "2.txt", [reading(60)])  # moves the watermark past every earlier window
    take()
    send(log, "3.txt", [reading(3, temperature=99.0)])  # an hour late
    take()
    send(log, "4.txt", [reading(200)])  # closing batch
    take()
    batch = decode_readings(spark.createDataFrame([(json.dumps(r),) for r in [*kept, reading(60)]], "value STRING"))
    assert rows(spark.read.parquet(out)) == rows(five_minute_windows(batch))


def test_readings_without_sensor_or_json_are_rejected(spark):
    sent = [json.dumps(reading(1)), json.dumps(reading(1, sensor=None)), "{oops"]
    log = spark.createDataFrame([(text,) for text in sent], "value STRING")
    assert decode_readings(log).count() == 1


def gate(tmp_path):
    return ReadingBatches(*(str(tmp_path / n) for n in ("raw", "windows", "quarantine")))


def frame(spark, temperatures):
    data = [("s", "c", START + dt.timedelta(minutes=i), t) for i, t in enumerate(temperatures)]
    df = spark.createDataFrame(data, "sensor_id STRING, city STRING, event_time TIMESTAMP, temperature_c DOUBLE")
    return df.withColumns({"humidity_pct": F.lit(50.0), "precipitation_mm": F.lit(0.5)})


def test_gate_at_its_threshold(spark, tmp_path):
    body = gate(tmp_path)
    for batch_id, missing in enumerate((6, 5, 4)):
        body(frame(spark, [None] * missing + [1.0] * (100 - missing)), batch_id)
    body(frame(spark, []), 3)
    accepted = spark.read.parquet(body.raw).groupBy("batch_id").count()
    assert {tuple(r) for r in accepted.collect()} == {(1, 100), (2, 100)}
    assert spark.read.parquet(body.quarantine).where("batch_id = 0").count() == 100


def test_replayed_batch_changes_nothing(spark, rows, tmp_path):
    body = gate(tmp_path)
    batch = frame(spark, [1.0] * 20 + [50.0])
    body(batch, 7)
    before = rows(spark.read.parquet(body.raw)), rows(spark.read.parquet(body.windows))
    body(batch, 7)
    assert (rows(spark.read.parquet(body.raw)), rows(spark.read.parquet(body.windows))) == before
    assert spark.read.parquet(body.raw).where("is_anomaly").count() == 1


def test_one_row_and_constant_batches_have_no_anomaly(spark, tmp_path):
    body = gate(tmp_path)
    body(frame(spark, [5.0]), 0)
    body(frame(spark, [5.0] * 4), 1)
    assert spark.read.parquet(body.raw).where("is_anomaly").count() == 0


def test_states_over_batches_equal_one_pass(spark, tmp_path):
    body = gate(tmp_path)
    body(frame(spark, [1.25, 2.5, 3.0]), 0)
    body(frame(spark, [4.0, 5.5, 6.0, 7.0]), 1)
    row = windows_of_states(spark.read.parquet(body.windows)).first()
    assert (row["reading_count"], row["min_temp_c"], row["max_temp_c"]) == (7, 1.25, 7.0)
    assert row["avg_temp_c"] == 29.25 / 7 and row["avg_humidity_pct"] == 50.0 and row["total_precip_mm"] == 3.5


def test_processing_time_trigger_and_update_mode(spark, rows, tmp_path):
    log, out = tmp_path / "log", str(tmp_path / "out")
    send(log, "1.txt", [reading(0, temperature=1.0), reading(1, temperature=3.0)])
    stream = windowed_readings(decode_readings(open_stream(spark, Log(str(log), "text"))))

    def keep(batch, batch_id):
        replace_slice(batch.withColumn("batch_id", F.lit(batch_id)), out, ["batch_id"])

    query = start(stream, str(tmp_path / "cp"), body=keep, every="1 second", mode="update")
    try:
        query.processAllAvailable()
        send(log, "2.txt", [reading(2, temperature=5.0)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.read.parquet(out), "reading_count", "avg_temp_c") == [(2, 2.0), (3, 3.0)]


def test_bodies_run_adaptively_behind_a_stateful_stream(spark, rows, tmp_path):
    """Redelivered prices are dropped in the stream, then stored by the batch body."""
    from tidemill.plans import prices

    log, seen = tmp_path / "log", []
    event = {"coin_id": "x", "current_price_usd": 1.0, "last_updated": START.isoformat() + "Z"}
    send(log, "1.txt", [event, event, {**event, "coin_id": "y"}])
    stream = prices.enrich_prices(prices.decode_prices(open_stream(spark, Log(str(log), "text"))))
    body = PriceBatches(str(tmp_path / "series"), str(tmp_path / "latest"))

    def watched(batch, batch_id):
        with held(batch) as kept:
            plan = kept.groupBy("coin_id").count()._jdf.queryExecution().executedPlan().toString()
            seen.append("AdaptiveSparkPlan" in plan)
        body(batch, batch_id)

    run(stream_dedup(stream, ["coin_id", "last_updated"], "event_time", "1 hour"), str(tmp_path / "cp"), body=watched)
    assert set(seen) == {True}
    assert rows(spark.read.parquet(body.series), "coin_id") == [("x",), ("y",)]


@pytest.mark.parametrize("spread", [0, 4])
def test_stream_dedup_over_batches(spark, tmp_path, spread):
    log = tmp_path / "log"
    for i in range(3):
        send(log, f"{i}.txt", [reading(m, sensor=f"s{m}") for m in (1, 2, 3 + i)] + [reading(7, sensor="hot")] * 40)
    stream = decode_readings(open_stream(spark, Log(str(log), "text", intake=1)))
    out = str(tmp_path / "out")
    run(stream_dedup(stream, ["sensor_id"], "event_time", "1 hour", spread), str(tmp_path / "cp"), path=out)
    assert sorted(r["sensor_id"] for r in spark.read.parquet(out).collect()) == ["hot", "s1", "s2", "s3", "s4", "s5"]


POST = """
    post_id STRING, subreddit STRING, title STRING, body STRING, score INT, flair STRING,
    created_utc TIMESTAMP, ingested_at TIMESTAMP
"""
LEXICON = {"good": (3.0, 0.7), "bad": (-2.5, -0.7)}


def post(key, hours, title, score=1, flair=None):
    return (key, "f", title, None, score, flair, START, START + dt.timedelta(hours=hours))


def test_post_upserts_by_field(spark, rows, tmp_path):
    body = PostBatches(LEXICON, str(tmp_path / "p"), str(tmp_path / "s"))
    body(spark.createDataFrame([post("1", 0, "good", flair="x"), post("2", 0, "bad")], POST), 0)
    update = spark.createDataFrame([post("1", 1, "bad", score=5), post("1", 2, None, score=6)], POST)
    for _ in range(2):
        body(update, 1)
    for _ in range(2):
        assert rows(body.current_posts(spark), "post_id", "title", "flair", "score") == [
            ("1", "bad", "x", 6), ("2", "bad", None, 1)]
        labels = rows(body.current_sentiment(spark), "post_id", "sentiment_label")
        assert labels == [("1", "neutral"), ("2", "negative")]
        body.settle(spark)
        assert spark.read.parquet(body.posts).count() == 2
    moved = spark.createDataFrame([post("1", 3, "good")], POST).withColumn("created_utc", F.lit(None).cast("timestamp"))
    body(moved, 2)
    body.settle(spark)
    assert rows(body.current_posts(spark), "post_id", "title", "created_utc")[0] == ("1", "good", START)


def test_late_price_does_not_replace_a_newer_one(spark, rows, tmp_path):
    from tidemill.plans.prices import LATEST_FIELDS

    body = PriceBatches(str(tmp_path / "series"), str(tmp_path / "latest"))
    for batch_id, (hours, price) in enumerate(((5, 10.0), (3, 7.0), (6, 11.0), (6, 11.0))):
        base = spark.createDataFrame(
            [("x", START + dt.timedelta(hours=hours), price)],
            "coin_id STRING, event_time TIMESTAMP, current_price_usd DOUBLE",
        )
        extra = {c: F.lit(None).cast("string") for c in LATEST_FIELDS if c not in base.columns}
        body(base.withColumns(extra), batch_id)
    for _ in range(2):
        assert rows(body.current_prices(spark), "coin_id", "current_price_usd") == [("x", 11.0)]
        body.settle(spark)
    assert spark.read.parquet(body.latest).count() == 1
    assert spark.read.parquet(body.series).count() == 4


def test_last_batch_replayed_after_settle(spark, rows, tmp_path):
    """A driver lost before the stream commits a batch replays it after a settle between."""
    from tidemill.plans.prices import LATEST_FIELDS

    body = PostBatches(LEXICON, str(tmp_path / "p"), str(tmp_path / "s"))
    first = spark.createDataFrame([post(str(k), 0, "good", flair="x") for k in range(4)], POST)
    last = spark.createDataFrame([post("1", 1, "bad", score=5), post("1", 2, None, score=6)], POST)
    prices = PriceBatches(str(tmp_path / "series"), str(tmp_path / "latest"))

    def priced(*rows):
        base = spark.createDataFrame(
            [(k, START + dt.timedelta(hours=hours), price) for k, hours, price in rows],
            "coin_id STRING, event_time TIMESTAMP, current_price_usd DOUBLE",
        )
        return base.withColumns({c: F.lit(None).cast("string") for c in LATEST_FIELDS if c not in base.columns})

    body(first, 0)
    prices(priced(("x", 1, 1.0), ("y", 1, 2.0)), 0)
    posts = [("0", "good", "x", 1), ("1", "bad", "x", 6), ("2", "good", "x", 1), ("3", "good", "x", 1)]
    for replay in (False, True, True):
        body(last, 1)
        prices(priced(("x", 2, 3.0)), 1)
        for settled in (False, True):
            if settled:
                body.settle(spark)
                prices.settle(spark)
            assert rows(body.current_posts(spark), "post_id", "title", "flair", "score") == posts, replay
            assert rows(body.current_sentiment(spark), "post_id") == [("0",), ("1",), ("2",), ("3",)]
            assert rows(prices.current_prices(spark), "coin_id", "current_price_usd") == [("x", 3.0), ("y", 2.0)]
    # The batch whose writes were cut short: its replay counts, and so do later ones.
    body(spark.createDataFrame([post("2", 3, "bad", score=7)], POST), 2)
    body.settle(spark)
    body(spark.createDataFrame([post("2", 3, "bad", score=7), post("2", 4, "good", score=8)], POST), 2)
    body(spark.createDataFrame([post("3", 0, None, score=9)], POST), 3)
    body.settle(spark)
    posts[2:] = [("2", "good", "x", 8), ("3", "good", "x", 9)]
    assert rows(body.current_posts(spark), "post_id", "title", "flair", "score") == posts
    assert spark.read.parquet(body.posts).count() == 4


def test_reading_job_runs_and_restarts(spark, tmp_path):
    log, folder = tmp_path / "log", str(tmp_path / "lake")
    for name, minutes in (("1.txt", range(10)), ("2.txt", range(10, 15))):
        send(log, name, [reading(m) for m in minutes])
        jobs.watch_readings(spark, Log(str(log), "text"), folder, every=None).awaitTermination()
    raw = spark.read.parquet(f"{folder}/raw")
    assert raw.count() == 15 and raw.select("batch_id").distinct().count() == 2
    assert jobs.final_windows(spark, folder).count() == 3
    assert jobs.settle_windows(spark, folder, START.date()) == 3
    settled = spark.read.parquet(f"{folder}/settled_windows").drop("window_date")
    assert settled.exceptAll(jobs.final_windows(spark, folder)).isEmpty()
    assert jobs.check_readings(raw.withColumn("humidity_pct", F.lit(1.0)), "2024-01-01 00:30:00")["verdict"] == "ok"


def test_window_post_and_price_jobs(spark, tmp_path):
    send(tmp_path / "r", "1.txt", [reading(0), reading(600)])
    jobs.watch_windows(spark, Log(str(tmp_path / "r"), "text"), str(tmp_path / "w"), every=None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "w/final_windows")).count() == 1
    created = START.isoformat() + "Z"
    send(tmp_path / "p", "1.txt", [{"post_id": "1", "title": "good", "created_utc": created}, {"title": "no id"}])
    sent = Log(str(tmp_path / "p"), "text")
    jobs.watch_posts(spark, sent, str(tmp_path / "posts"), LEXICON, every=None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "posts/sentiment")).first()["sentiment_label"] == "positive"
    send(tmp_path / "q", "1.txt", [{"coin_id": "x", "price_change_24h_pct": -10.0, "last_updated": created}])
    jobs.watch_prices(spark, Log(str(tmp_path / "q"), "text"), str(tmp_path / "prices"), every=None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "prices/latest")).first()["volatility_class"] == "extreme"
    assert jobs.settle_prices(spark, str(tmp_path / "prices"), START.date()) == 1


def test_daily_refresh_equals_the_whole_table(spark, sf, tmp_path):
    from tidemill.plans import posts as posts_plan
    from tidemill.plans import readings as readings_plan
    from tidemill.registered.base import AS_OF, LEXICON, POSTS, READINGS

    stored, path = READINGS.df(spark, sf), str(tmp_path / "hours")
    scored, days = posts_plan.score_posts(POSTS.df(spark, sf), LEXICON).cache(), str(tmp_path / "days")
    for n in (3, 4, 4):  # a day may be refreshed again
        jobs.refresh_sensor_hours(stored, path, dt.date(2024, 1, n))
        jobs.refresh_forum_day(scored, days, dt.date(2024, 1, n))
    whole = readings_plan.hourly_aggregates(stored, AS_OF, days=31).where(
        "to_date(hour_bucket) IN (DATE '2024-01-03', DATE '2024-01-04')"
    )
    hours = spark.read.parquet(path).drop("event_date")
    assert hours.count() == whole.count() and hours.exceptAll(whole).isEmpty()
    whole = posts_plan.daily_aggregates(scored, AS_OF).where("post_date IN (DATE '2024-01-03', DATE '2024-01-04')")
    kept = spark.read.parquet(days).select(whole.columns)
    assert kept.count() == whole.count() and kept.exceptAll(whole).isEmpty()


def test_batch_jobs(spark, tmp_path):
    day, lake = dt.date(2024, 1, 31), str(tmp_path / "lake")
    repo = {"repo_id": 1, "stars": 3, "forks": 1, "watchers": 1, "created_at": "2024-01-01"}
    send(tmp_path / "repos", "1.txt", [repo])
    send(tmp_path / "days", "1.txt", [{"city": "c", "date": "2024-01-30", "temp_max_c": 3.0, "temp_min_c": 1.0}])
    send(tmp_path / "ind", "1.txt", [
        {"country_code": "a", "country_name": "x", "indicator_name": "gdp_current_usd", "year": y, "value": v}
        for y, v in ((2022, 1e9), (2023, 2e9))])
    for _ in range(2):  # a rerun of the day replaces its slice
        assert jobs.ingest_repositories(spark, Log(str(tmp_path / "repos"), "text"), lake, day) == 1
        assert jobs.ingest_weather(spark, Log(str(tmp_path / "days"), "text"), lake, day) == 1
        assert jobs.build_panel(spark, Log(str(tmp_path / "ind"), "text"), lake, day) == 2
    assert spark.read.parquet(f"{lake}/repositories").count() == 1
    assert spark.read.parquet(f"{lake}/audit").count() == 3
    mart = jobs.build_economy_mart(spark, lake, day).first()
    assert (mart["country_code"], mart["gdp_billion_usd"], mart["gdp_yoy_change_pct"]) == ("A", 2.0, 100.0)
    send(tmp_path / "ohlc", "1.txt", [
        {"coin_id": "x", "candle_date": f"2024-01-0{i}", "open": 1.0, "high": 2.0, "low": 1.0, "close": float(i)}
        for i in range(3)])
    target = Target.folder(str(tmp_path / "candles"))
    assert jobs.load_candles(spark, Log(str(tmp_path / "ohlc"), "text"), target, day) == 2
