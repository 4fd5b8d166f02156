"""Ready-made jobs: where the logs are read, what runs, where results go.

Each job is source -> transforms -> sink.  Start one from a script given to
spark-submit:

    from tidemill.jobs import watch_readings
    from tidemill.session import build_session
    from tidemill.sources.logs import Log

    spark = build_session("readings")
    log = Log("sensor-readings", options={"kafka.bootstrap.servers": "broker:9092"})
    watch_readings(spark, log, "s3a://lake/readings", every="60 seconds").awaitTermination()
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill import schemas
from tidemill.functions.records import decode
from tidemill.functions.time import clock
from tidemill.operators import quality
from tidemill.operators.dedup import latest_per_key
from tidemill.plans import indicators, posts, prices, readings, repositories, weather
from tidemill.plans.loads import log_run
from tidemill.sinks.tables import Target, counted, drop_slices, expire, overwrite, replace_slice
from tidemill.sources.logs import Log, open_stream, read_log
from tidemill.streaming.jobs import (
    AccountedWindows, LiveWindows, PostBatches, PriceBatches, ReadingBatches, start, windowed_readings,
)

# -- streams ------------------------------------------------------------------


def watch_readings(spark: SparkSession, log: Log, folder: str, every: str | None = "60 seconds") -> StreamingQuery:
    """Gate, flag and store readings; keep window states per batch."""
    stream = readings.decode_readings(open_stream(spark, log)).withWatermark("event_time", "2 minutes")
    sinks = ReadingBatches(f"{folder}/raw", f"{folder}/windows", f"{folder}/quarantine")
    return start(stream, f"{folder}/checkpoint", body=sinks, every=every)


def watch_windows(spark: SparkSession, log: Log, folder: str, every: str | None = "60 seconds") -> StreamingQuery:
    """Final five-minute windows, each written once when the watermark closes it."""
    stream = windowed_readings(readings.decode_readings(open_stream(spark, log)))
    return start(stream, f"{folder}/checkpoint", path=f"{folder}/final_windows", every=every)


def watch_live_windows(spark: SparkSession, log: Log, folder: str, every: str | None = "60 seconds") -> StreamingQuery:
    """Five-minute windows as they change; reports do not wait for the watermark."""
    stream = windowed_readings(readings.decode_readings(open_stream(spark, log)))
    return start(stream, f"{folder}/checkpoint", body=LiveWindows(f"{folder}/live_windows"), every=every, mode="update")


def watch_accounted_windows(spark: SparkSession, log: Log, folder: str, every: str | None = "60 seconds") -> StreamingQuery:
    """Five-minute windows of the rows in time; rows that come too late are kept and counted."""
    sinks = AccountedWindows(f"{folder}/states", f"{folder}/late", f"{folder}/marks")
    return start(readings.decode_readings(open_stream(spark, log)), f"{folder}/checkpoint", body=sinks, every=every)


def watch_posts(
    spark: SparkSession,
    log: Log,
    folder: str,
    lexicon: Mapping[str, tuple[float, float]],
    every: str | None = "30 seconds",
) -> StreamingQuery:
    """Score posts and keep one raw and one sentiment document per post."""
    stream = posts.decode_posts(open_stream(spark, log)).withWatermark("created_utc", "5 minutes")
    sinks = PostBatches(lexicon, f"{folder}/posts", f"{folder}/sentiment")
    return start(stream, f"{folder}/checkpoint", body=sinks, every=every)


def watch_prices(spark: SparkSession, log: Log, folder: str, every: str | None = "60 seconds") -> StreamingQuery:
    """Enrich price events, append the series, keep the latest price per key."""
    stream = prices.enrich_prices(prices.decode_prices(open_stream(spark, log)), F.current_timestamp())
    sinks = PriceBatches(f"{folder}/series", f"{folder}/latest")
    return start(stream, f"{folder}/checkpoint", body=sinks, every=every)


def settle_upserts(spark: SparkSession, folder: str, sinks: PostBatches | PriceBatches) -> None:
    """Folds the stored batches of an upserted view; run it now and then between batches."""
    sinks.settle(spark)


def settle_prices(spark: SparkSession, folder: str, day: dt.date) -> int:
    """One day of the series without redelivered events, in few files sorted by key.

    The stream leaves small files per batch; run this once a day has passed.
    """
    series = spark.read.parquet(f"{folder}/series").where(F.col("event_date") == F.lit(day))
    settled = latest_per_key(series, ["coin_id", "event_time"], ["batch_id"]).drop("batch_id")
    path = f"{folder}/settled"
    return counted(
        lambda seen: replace_slice(
            settled, path, ["event_date"], ["coin_id", "event_time"], one_slice=True, seen=seen
        )
    )["rows"]


# -- batches ------------------------------------------------------------------


def final_windows(spark: SparkSession, folder: str, day: dt.date | None = None) -> DataFrame:
    """The windows of all stored batches (of one day), their states merged."""
    states = spark.read.parquet(f"{folder}/windows")
    if day is not None:
        states = states.where(F.col("window_date") == F.lit(day))
    return readings.windows_of_states(states)


def settle_windows(spark: SparkSession, folder: str, day: dt.date) -> int:
    """A day's merged windows as one slice, so that reports need not merge states."""
    windows = final_windows(spark, folder, day).withColumn("window_date", F.lit(day))
    path = f"{folder}/settled_windows"
    return counted(
        lambda seen: replace_slice(windows, path, ["window_date"], ["city", "window_start"], one_slice=True, seen=seen)
    )["rows"]


def refresh_sensor_hours(stored: DataFrame, path: str, day: dt.date) -> int:
    """The day's slice of the hourly dashboard table, instead of rebuilding all of it."""
    end = dt.datetime.combine(day + dt.timedelta(days=1), dt.time())
    hours = readings.hourly_aggregates(stored.where(F.col("event_time") < clock(end)), end, days=1)
    hours = hours.withColumn("event_date", F.lit(day))
    return counted(
        lambda seen: replace_slice(hours, path, ["event_date"], ["city", "hour_bucket"], one_slice=True, seen=seen)
    )["rows"]


def store_sensor_states(batch: DataFrame, path: str, batch_id: int) -> int:
    """What a batch adds to the hours of its sensors, for ``readings.anomaly_vs_stored_baseline``."""
    states = readings.sensor_hour_state(batch).withColumns({"event_date": F.to_date("hour"), "batch_id": F.lit(batch_id)})
    return counted(
        lambda seen: replace_slice(states, path, ["event_date", "batch_id"], ["sensor_id", "hour"], seen=seen)
    )["rows"]


def refresh_forum_day(stored: DataFrame, path: str, day: dt.date) -> int:
    """The day's slice of the forum dashboard table."""
    end = dt.datetime.combine(day + dt.timedelta(days=1), dt.time())
    rows = posts.daily_aggregates(stored.where(F.col("created_utc") < clock(end)), day, days=0)
    return counted(
        lambda seen: replace_slice(rows, path, ["post_date"], ["subreddit"], one_slice=True, seen=seen)
    )["rows"]


def _ingest(
    raw: DataFrame, build: Callable[[DataFrame], DataFrame], folder: str, table: str, day: dt.date
) -> int:
    """Replace the day's slice and log the run; returns the rows stored.

    The three counts of the audit are measured apart: records read, rows written, and rows
    that the stored slice holds afterwards.
    """
    spark, path = raw.sparkSession, f"{folder}/{table}"
    extracted = raw.count()
    rows = build(raw).withColumn("batch_date", F.lit(day))
    staged = counted(lambda seen: replace_slice(rows, path, ["batch_date"], one_slice=True, seen=seen))["rows"]
    if not staged:
        drop_slices(spark, path, "batch_date", lambda value: value == day.isoformat())
    stored = spark.read.schema(rows.schema).parquet(path) if staged else rows.limit(0)
    loaded = stored.where(F.col("batch_date") == F.lit(day)).count()
    log_run(spark, f"{folder}/audit", table, day, extracted, staged, loaded, dt.datetime.combine(day, dt.time()))
    return loaded


def ingest_repositories(spark: SparkSession, log: Log, folder: str, day: dt.date) -> int:
    raw = decode(read_log(spark, log), schemas.REPOSITORY)
    return _ingest(raw, lambda x: repositories.repository_features(x, day), folder, "repositories", day)


def ingest_weather(spark: SparkSession, log: Log, folder: str, day: dt.date) -> int:
    raw = decode(read_log(spark, log), schemas.DAILY_WEATHER)
    return _ingest(raw, lambda x: weather.weather_features(x, day), folder, "daily_weather", day)


def build_panel(spark: SparkSession, log: Log, folder: str, day: dt.date) -> int:
    """Long indicator log to the day's slice of the staging panel."""
    raw = decode(read_log(spark, log), schemas.COUNTRY_INDICATOR)
    return _ingest(raw, lambda x: indicators.panel(x, day, day.isoformat()), folder, "panel", day)


def expire_prices(spark: SparkSession, folder: str, day: dt.date, days: int = 30) -> list[str]:
    """Removes the days of the stored and the settled series that have outlived their time."""
    out = []
    for part in ("series", "settled"):
        # Prices without a time of their own live from the time at which they were enriched.
        out += expire(spark, f"{folder}/{part}", "event_date", day, days, written="processed_at")
    return out


def build_economy_mart(spark: SparkSession, folder: str, day: dt.date) -> DataFrame:
    """Staging view and mart over the day's panel."""
    panel = spark.read.parquet(f"{folder}/panel").where(F.col("batch_date") == F.lit(day))
    return indicators.economy_mart(indicators.staging(panel, day), day)


def load_candles(spark: SparkSession, log: Log, target: Target, day: dt.date) -> int:
    """Candle history with indicators into a warehouse table, replaced as a whole."""
    history = prices.technical_indicators(prices.candle_days(read_log(spark, log)), day)
    history = history.withColumn("batch_date", clock(day).cast("date"))
    return counted(lambda seen: overwrite(seen(history), target))["rows"]


def check_readings(stored: DataFrame, as_of) -> dict:
    """The reading quality report; raises when the gate is not met."""
    return quality.require(quality.reading_quality(stored, as_of))
