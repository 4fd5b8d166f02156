"""Registered streaming queries: each runs to the end of its log and returns the sink.

The log is written from the tables into the shared folder, read as a stream in
available-now mode, and the result has the batch query as its SQL twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.records import encode
from tidemill.operators.dedup import latest_per_key, stream_dedup
from tidemill.operators.merge import BATCH
from tidemill.plans import posts as posts_plan
from tidemill.plans import prices as prices_plan
from tidemill.plans import readings as readings_plan
from tidemill.registered.base import LEXICON, POSTS, READINGS, SCORED, Registered, mean, table, total
from tidemill.registered.prices import _PRICE_FIELDS, EVENTS_SQL, LATEST_SQL, price_log
from tidemill.session import new_folder
from tidemill.sources.logs import Log, open_stream
from tidemill.streaming.jobs import (
    CREATED_DAY, AccountedWindows, LiveWindows, PostBatches, PriceBatches, ReadingBatches, caught_up, run, serve,
    windowed_readings,
)

QUERIES: dict[str, Registered] = {}


def _add(name, run_query, sql=None):
    QUERIES[name] = Registered(run_query, sql)


def _zone_free(df: DataFrame) -> DataFrame:
    zoned = {c: df[c].cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"}
    return df.withColumns(zoned) if zoned else df


def _sent(readings: DataFrame) -> DataFrame:
    """Readings as they are sent: times as text."""
    return encode(readings.drop("event_id", "batch_id", "synced", "weather_code").withColumn(
        "event_time", F.col("event_time").cast("string")
    ))


# -- stateful windows ----------------------------------------------------------------------


def _windows(spark, sf):
    """Append mode holds a window back until the watermark has passed its end, so the
    log ends with one reading of a later day, whose own window stays open."""
    rows, path = READINGS.df(spark, sf), new_folder(spark, "window-log")
    _sent(rows).write.text(path)
    closing = rows.agg(
        F.lit("closing").alias("sensor_id"), F.lit("closing").alias("city"),
        (F.max("event_time") + F.expr("INTERVAL 1 DAY")).cast("string").alias("event_time"),
    )
    encode(closing).write.mode("append").text(path)
    stream = readings_plan.decode_readings(open_stream(spark, Log(path, "text")))
    out = new_folder(spark, "windows")
    run(windowed_readings(stream), new_folder(spark, "checkpoint"), path=out)
    return _zone_free(spark.read.parquet(out))


BASE = f"({READINGS.sql}) r"


def _windows_sql(where: str) -> str:
    return f"""
    SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
           time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end, city,
           {mean('temperature_c')} AS avg_temp_c, min(temperature_c) AS min_temp_c,
           max(temperature_c) AS max_temp_c, {mean('humidity_pct')} AS avg_humidity_pct,
           {total('precipitation_mm')} AS total_precip_mm, count(*) AS reading_count
    FROM {BASE} WHERE {where} GROUP BY ALL
    """


_add("windowed_readings_stream", _windows, _windows_sql("TRUE"))

# -- late rows, open windows, timed runs -------------------------------------------------------

# Three deliveries; most rows of the last come long after the watermark has passed them.
_DELIVERIES = ("batch_id = 0 AND event_time < TIMESTAMP '2024-01-12 00:00:00'", "batch_id = 1", "batch_id IN (2, 3)")


def _accounted(spark, sf):
    rows, path = READINGS.df(spark, sf), new_folder(spark, "late-log")
    sinks = AccountedWindows(*(new_folder(spark, name) for name in ("states", "late", "marks")))
    checkpoint = new_folder(spark, "checkpoint")
    for delivery in _DELIVERIES:
        _sent(rows.where(delivery)).write.mode("append").text(path)
        stream = readings_plan.decode_readings(open_stream(spark, Log(path, "text")))
        run(stream, checkpoint, body=sinks)
    return sinks


_LATE_SQL = f"""
    SELECT *, coalesce(time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE <= watermark, FALSE) AS is_late
    FROM (
        SELECT *, CASE nth WHEN 2 THEN (SELECT max(event_time) FROM {BASE} WHERE {_DELIVERIES[0]})
                  WHEN 3 THEN (SELECT max(event_time) FROM {BASE} WHERE ({_DELIVERIES[0]}) OR {_DELIVERIES[1]})
                  END - INTERVAL 2 MINUTE AS watermark
        FROM (
            SELECT *, CASE WHEN {_DELIVERIES[0]} THEN 1 WHEN {_DELIVERIES[1]} THEN 2 WHEN {_DELIVERIES[2]} THEN 3 END AS nth
            FROM {BASE})
        WHERE nth IS NOT NULL)
"""

_add(
    "late_readings_kept",
    lambda spark, sf: _zone_free(
        _accounted(spark, sf).late_rows(spark).select("sensor_id", "city", "event_time", "temperature_c", "watermark")
    ),
    f"SELECT sensor_id, city, event_time, temperature_c, watermark FROM ({_LATE_SQL}) WHERE is_late",
)
_add(
    "windows_of_rows_in_time",
    lambda spark, sf: _zone_free(_accounted(spark, sf).windows(spark)),
    _windows_sql("NOT is_late").replace(BASE, f"({_LATE_SQL}) r"),
)


def _row_counts(spark, sf):
    """What the marks say of the rows sent, in windows and late, beside what the tables hold."""
    sinks = _accounted(spark, sf)
    counts = sinks.counts(spark)
    held = sinks.windows(spark).agg(F.sum("reading_count").alias("in_windows"))
    kept = sinks.late_rows(spark).agg(F.count(F.lit(1)).alias("in_late_table"))
    # One row each; together they are summed up, so no product of rows is planned.
    both = held.unionByName(kept, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("in_windows", "in_late_table")])
    return both.withColumns({k: F.lit(v).cast("long") for k, v in counts.items()})


_add(
    "late_readings_accounted",
    _row_counts,
    f"""
    SELECT count(*) AS sent, count(*) FILTER (WHERE NOT is_late) AS in_time, count(*) FILTER (WHERE is_late) AS late,
           CAST(0 AS BIGINT) AS untimed, count(*) FILTER (WHERE NOT is_late) AS in_windows,
           count(*) FILTER (WHERE is_late) AS in_late_table
    FROM ({_LATE_SQL})
    """,
)


def _live_windows(spark, sf):
    """Update mode: four deliveries in order of time; no window waits for the watermark."""
    rows, path = READINGS.df(spark, sf), new_folder(spark, "live-log")
    sinks, checkpoint = LiveWindows(new_folder(spark, "live-windows")), new_folder(spark, "checkpoint")
    ends = [f"TIMESTAMP '2024-01-{day:02} 07:13:00'" for day in (1, 9, 16, 23)] + ["TIMESTAMP '2025-01-01 00:00:00'"]
    for begin, end in zip(["TIMESTAMP '2023-01-01 00:00:00'", *ends], ends):
        _sent(rows.where(f"event_time >= {begin} AND event_time < {end}")).write.mode("append").text(path)
        stream = readings_plan.decode_readings(open_stream(spark, Log(path, "text")))
        run(windowed_readings(stream), checkpoint, body=sinks, mode="update")
    return _zone_free(sinks.windows(spark))


_add("live_windows_stream", _live_windows, _windows_sql("TRUE"))


def _timed(spark, sf):
    """A query on a timer, stopped between two batches, then resumed from its checkpoint."""
    rows, path = READINGS.df(spark, sf), new_folder(spark, "timed-log")
    folders = {name: new_folder(spark, name) for name in ("raw", "windows", "quarantine")}
    checkpoint = new_folder(spark, "checkpoint")
    for delivery in ("batch_id < 2", "batch_id >= 2"):
        part = rows.where(delivery)
        _sent(part).write.mode("append").text(path)
        stream = readings_plan.decode_readings(open_stream(spark, Log(path, "text")))
        body = ReadingBatches(**folders, min_completeness=0.0)
        serve(stream, checkpoint, "1 second", caught_up(part.count()), body=body)
    stored = spark.read.parquet(folders["raw"])
    return _zone_free(stored.select("sensor_id", "city", "event_time", "temperature_c", "humidity_pct"))


_add(
    "timed_readings_resumed",
    _timed,
    f"SELECT sensor_id, city, event_time, temperature_c, humidity_pct FROM {BASE}",
)

# -- gated micro-batches ---------------------------------------------------------------------

_GOOD = "batch_id <> 3"


def _gated(spark, sf):
    """Two deliveries into one log, the query restarted from its checkpoint in between.
    The second delivery lacks too many temperatures and is quarantined."""
    rows, path = READINGS.df(spark, sf), new_folder(spark, "gated-log")
    folders = {name: new_folder(spark, name) for name in ("raw", "windows", "quarantine")}
    checkpoint = new_folder(spark, "checkpoint")
    for delivery in (_GOOD, f"NOT ({_GOOD})"):
        _sent(rows.where(delivery)).write.mode("append").text(path)
        stream = readings_plan.decode_readings(open_stream(spark, Log(path, "text")))
        run(stream.withWatermark("event_time", "2 minutes"), checkpoint, body=ReadingBatches(**folders))
    return folders


def _gated_rows(spark, sf):
    folders = _gated(spark, sf)
    raw = spark.read.parquet(folders["raw"]).withColumn("quarantined", F.lit(False))
    held = spark.read.parquet(folders["quarantine"]).withColumn("quarantined", F.lit(True))
    names = ["sensor_id", "city", "event_time", "temperature_c", "is_anomaly", "batch_id", "quarantined"]
    rows = raw.unionByName(held, allowMissingColumns=True).select(*names)
    return _zone_free(rows.withColumn("is_anomaly", F.col("is_anomaly").cast("string")))


_add(
    "gated_reading_batches",
    _gated_rows,
    f"""
    WITH s AS (
        SELECT {mean('temperature_c')} AS m, stddev_samp(temperature_c) AS sd FROM {BASE} WHERE {_GOOD})
    SELECT sensor_id, city, event_time, temperature_c,
           CAST(CASE WHEN {_GOOD} THEN coalesce(
               abs(temperature_c - (SELECT m FROM s)) > 2 * (SELECT sd FROM s), FALSE) END AS VARCHAR) AS is_anomaly,
           CASE WHEN {_GOOD} THEN 0 ELSE 1 END AS batch_id, NOT ({_GOOD}) AS quarantined
    FROM {BASE}
    """,
)
_add(
    "gated_window_states",
    lambda spark, sf: _zone_free(
        readings_plan.windows_of_states(spark.read.parquet(_gated(spark, sf)["windows"]))
    ),
    _windows_sql(_GOOD),
)

# -- scored and upserted posts ------------------------------------------------------------------


def _posts(spark, sf, settled=False):
    """All posts, then a second delivery of the labelled ones: new votes, some fields missing."""
    path, checkpoint = new_folder(spark, "post-log"), new_folder(spark, "checkpoint")
    sinks = PostBatches(LEXICON, new_folder(spark, "posts"), new_folder(spark, "sentiment"))
    rows = POSTS.df(spark, sf)
    again = rows.join(table(spark, sf, "labels"), "doc_id").withColumns(
        {
            "score": F.col("score") + 1000,
            "flair": F.when(F.col("toxic") == 1, F.lit("toxic")),
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"),
        }
    ).select(rows.columns)
    for delivery in (rows, again):
        times = {c: F.col(c).cast("string") for c in ("created_utc", "ingested_at")}
        encode(delivery.withColumns(times).drop("doc_id")).write.mode("append").text(path)
        stream = posts_plan.decode_posts(open_stream(spark, Log(path, "text")))
        run(stream.withWatermark("created_utc", "5 minutes"), checkpoint, body=sinks)
    if settled:
        sinks.settle(spark)
    stored = sinks.current_posts(spark).select("post_id", "flair", "num_comments", "upvote_ratio", "ingested_at")
    documents = sinks.current_sentiment(spark).drop(CREATED_DAY, BATCH, "ingested_at")
    return _zone_free(documents.join(stored, "post_id"))


_POSTS_SQL = f"""
    SELECT post_id, subreddit, compound_score, polarity_score, sentiment_score, sentiment_label,
           CASE WHEN toxic IS NOT NULL THEN score + 1000 ELSE score END AS score, created_utc,
           CASE WHEN toxic = 1 THEN 'toxic' ELSE flair END AS flair, num_comments, upvote_ratio,
           CASE WHEN toxic IS NOT NULL THEN ingested_at + INTERVAL 1 HOUR ELSE ingested_at END AS ingested_at
    FROM ({SCORED}) LEFT JOIN labels USING (doc_id)
    """
_add("posts_scored_and_upserted_stream", _posts, _POSTS_SQL)
_add("posts_settled_after_stream", lambda spark, sf: _posts(spark, sf, settled=True), _POSTS_SQL)

# -- price events -------------------------------------------------------------------------------


def _price_stream(spark, sf, log: Log) -> DataFrame:
    return prices_plan.enrich_prices(prices_plan.decode_prices(open_stream(spark, log)))


def _price_series(spark, sf):
    """Events appended to the time series by day; redelivered events resolve by key on read."""
    sinks = PriceBatches(new_folder(spark, "series"), new_folder(spark, "latest"))
    log = price_log(spark, sf)
    run(_price_stream(spark, sf, log), new_folder(spark, "checkpoint"), body=sinks)
    return sinks


_add(
    "price_series_stream",
    lambda spark, sf: _zone_free(
        latest_per_key(
            spark.read.parquet(_price_series(spark, sf).series), ["coin_id", "event_time"], ["batch_id"]
        ).select(*_PRICE_FIELDS)
    ),
    f"SELECT {', '.join(_PRICE_FIELDS)} FROM ({EVENTS_SQL})",
)
_add(
    "latest_price_view_stream",
    lambda spark, sf: _zone_free(_price_series(spark, sf).current_prices(spark)),
    LATEST_SQL,
)


def _deduplicated(spark, sf):
    """Redelivered events dropped in the stream, with an intake limit per trigger."""
    log = price_log(spark, sf, files=4)
    limited = Log(log.name, "text", intake=2)
    stream = stream_dedup(
        _price_stream(spark, sf, limited), ["coin_id", "last_updated"], "event_time", "60 days", spread=8
    )
    out = new_folder(spark, "deduplicated")
    run(stream, new_folder(spark, "checkpoint"), path=out)
    return _zone_free(spark.read.parquet(out).select(*_PRICE_FIELDS))


_add(
    "price_stream_deduplicated",
    _deduplicated,
    f"SELECT {', '.join(_PRICE_FIELDS)} FROM ({EVENTS_SQL})",
)
