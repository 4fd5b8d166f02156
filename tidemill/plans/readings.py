"""Sensor readings: decoding, anomaly flags, window roll-ups, trend reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.functions.numeric import outlier, ratio
from tidemill.functions.records import decode
from tidemill.functions.sums import mean, stddev, total, with_products
from tidemill.functions.time import before, hour_of, since
from tidemill.operators.dedup import latest_per_key
from tidemill.operators.rollups import merge_state, partial_state, rollup, state_mean, state_stddev, state_total, union_all

# Fixed value: how many standard deviations make an anomaly.
ANOMALY_LIMIT = 2.0


def decode_readings(log: DataFrame) -> DataFrame:
    """Readings from a log (stream or batch), without those that lack a sensor."""
    return decode(log, schemas.SENSOR_READING).where(F.col("sensor_id").isNotNull())


def flag_anomalies(readings: DataFrame, column: str = "temperature_c") -> DataFrame:
    """``is_anomaly`` against the mean and deviation of all given rows.

    The statistics are one scalar subquery: a single aggregate pass whose one
    row is filled into the projection.
    """
    stats = with_products(readings, (column, column)).agg(
        F.struct(mean(column).alias("mean"), stddev(column).alias("std")).alias("s")
    ).scalar()
    return readings.withColumn("is_anomaly", outlier(column, stats["mean"], stats["std"], ANOMALY_LIMIT))


def five_minute_windows(
    readings: DataFrame, keys: Sequence[str] = ("city",), width: str = "5 minutes"
) -> DataFrame:
    """Tumbling windows; on a stream it is a stateful aggregate (set a watermark)."""
    measures = {
        "avg_temp_c": mean("temperature_c"),
        "min_temp_c": F.min("temperature_c"),
        "max_temp_c": F.max("temperature_c"),
        "avg_humidity_pct": mean("humidity_pct"),
        "total_precip_mm": total("precipitation_mm"),
        "reading_count": F.count(F.lit(1)),
    }
    rows = rollup(readings, [F.window("event_time", width).alias("w"), *keys], **measures)
    return rows.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *measures
    )


def window_state(
    readings: DataFrame, keys: Sequence[str] = ("city",), width: str = "5 minutes"
) -> DataFrame:
    """What one batch adds to its tumbling windows, in mergeable form."""
    state = partial_state(
        readings, [F.window("event_time", width).alias("w"), *keys],
        means=["temperature_c", "humidity_pct"], totals=["precipitation_mm"], extremes=["temperature_c"],
    )
    return state.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*").drop("w")


def windows_of_states(states: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    """The windows of ``five_minute_windows`` from the states of all batches."""
    merged = merge_state(states, ["window_start", "window_end", *keys])
    return merged.select(
        "window_start", "window_end", *keys,
        state_mean("temperature_c").alias("avg_temp_c"),
        F.col("lo_temperature_c").alias("min_temp_c"),
        F.col("hi_temperature_c").alias("max_temp_c"),
        state_mean("humidity_pct").alias("avg_humidity_pct"),
        state_total("precipitation_mm").alias("total_precip_mm"),
        F.col("n_rows").alias("reading_count"),
    )


def hourly_trend(readings: DataFrame, as_of, hours: int = 48) -> DataFrame:
    """Temperature, humidity and precipitation per city and hour."""
    recent = readings.where(since("event_time", as_of, f"{hours} HOUR"))
    return rollup(
        recent,
        ["city", hour_of("event_time").alias("hour_bucket")],
        avg_temp_c=F.round(mean("temperature_c"), 2),
        min_temp_c=F.round(F.min("temperature_c"), 2),
        max_temp_c=F.round(F.max("temperature_c"), 2),
        avg_humidity=F.round(mean("humidity_pct"), 1),
        total_precip_mm=F.round(total("precipitation_mm"), 2),
        readings=F.count(F.lit(1)),
    ).orderBy("city", F.col("hour_bucket").desc())


def anomaly_vs_baseline(readings: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Each sensor's latest reading against its baseline of the last days.

    The baseline leaves out the last hour and is kept per city and sensor, so a
    sensor that reported from two cities is compared with both.  Both sides are
    reduced per key before they are joined.
    """
    span = F.col("event_time").between(before(as_of, f"{days} DAY"), before(as_of, "1 HOUR"))
    baseline = rollup(
        with_products(readings.where(span), ("temperature_c", "temperature_c")),
        [F.col("city").alias("baseline_city"), "sensor_id"],
        baseline_temp=mean("temperature_c"),
        stddev=stddev("temperature_c"),
    )
    latest = latest_per_key(
        readings.select("sensor_id", "city", "temperature_c", "event_time"), ["sensor_id"], ["event_time", "city"]
    )
    return _against_baseline(latest, baseline)


def sensor_hour_state(readings: DataFrame) -> DataFrame:
    """What readings add to the hours of their sensors: moments of the temperature and the newest reading.

    Rows without a time belong to the hour NULL; they count for the newest reading only if a
    sensor has no others.
    """
    return partial_state(
        readings, [hour_of("event_time").alias("hour"), "city", "sensor_id"],
        means=["temperature_c"], spreads=["temperature_c"],
        newest={"reading": ["event_time", "city", "temperature_c"]},
    )


def anomaly_vs_stored_baseline(states: DataFrame, readings: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The rows of ``anomaly_vs_baseline``, of stored hours instead of all readings.

    ``states`` holds the ``sensor_hour_state`` of all readings, of any batches.  Raw rows are
    read for the hours that the baseline's ends cut only; the scan gets both bounds of each.
    """
    begin, end = before(as_of, f"{days} DAY"), before(as_of, "1 HOUR")
    hour, hours = F.col("hour"), F.expr("INTERVAL 1 HOUR")
    whole = (hour >= begin) & (hour + hours <= end)
    if "event_date" in states.columns:  # stored by day: only the baseline's days are read
        whole &= F.col("event_date").between(begin.cast("date"), end.cast("date"))
    time, (first, last) = F.col("event_time"), (F.date_trunc("hour", x).cast("timestamp_ntz") for x in (begin, end))
    cut = (time < first + hours) & (first < begin) | (time >= last)
    cut = sensor_hour_state(readings.where(time.between(begin, end) & cut))
    merged = merge_state(union_all(states.where(whole), cut), ["city", "sensor_id"])
    baseline = merged.select(
        F.col("city").alias("baseline_city"), "sensor_id",
        state_mean("temperature_c").alias("baseline_temp"), state_stddev("temperature_c").alias("stddev"),
    )
    newest = states.groupBy("sensor_id").agg(F.max("hi_reading").alias("newest"))
    return _against_baseline(newest.select("sensor_id", "newest.city", "newest.temperature_c"), baseline)


def _against_baseline(latest: DataFrame, baseline: DataFrame) -> DataFrame:
    delta = F.col("temperature_c") - F.col("baseline_temp")
    z = ratio(delta, "stddev")
    return (
        latest.join(baseline, "sensor_id")
        .select(
            "city",
            "baseline_city",
            "sensor_id",
            F.round("temperature_c", 2).alias("current_temp_c"),
            F.round("baseline_temp", 2).alias("baseline_temp_c"),
            F.round("stddev", 2).alias("stddev_temp"),
            F.round(delta, 2).alias("delta_temp"),
            F.round(z, 2).alias("z_score"),
            F.when(F.abs(z) > ANOMALY_LIMIT, "ANOMALY").otherwise("NORMAL").alias("status"),
        )
        .orderBy(F.abs("delta_temp").desc_nulls_last(), "sensor_id", "baseline_city")
    )


def hourly_aggregates(readings: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Hourly dashboard table per city and sensor."""
    recent = readings.where(since("event_time", as_of, f"{days} DAY"))
    return rollup(
        recent,
        [hour_of("event_time").alias("hour_bucket"), "city", "sensor_id"],
        avg_temp_c=F.round(mean("temperature_c"), 2),
        max_temp_c=F.round(F.max("temperature_c"), 2),
        min_temp_c=F.round(F.min("temperature_c"), 2),
        avg_humidity_pct=F.round(mean("humidity_pct"), 2),
        avg_wind_speed_kmh=F.round(mean("wind_speed_kmh"), 2),
        total_precipitation_mm=F.round(total("precipitation_mm"), 2),
        event_count=F.count(F.lit(1)),
    )
