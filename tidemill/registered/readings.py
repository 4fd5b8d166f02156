"""Registered queries over sensor readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.functions.records import REJECT, decode_with_rejects, encode, nested_or
from tidemill.functions.time import before
from tidemill.jobs import store_sensor_states
from tidemill.operators import quality
from tidemill.operators.merge import mark
from tidemill.plans import readings as plan
from tidemill.plans.loads import export_increment, sync, sync_slices
from tidemill.registered.base import AS_OF, READINGS, Registered, mean, pct, ratio, rounded, total
from tidemill.session import new_folder
from tidemill.sinks.tables import conform, duplicate_keys, publish_table, replace_slice, write_files
from tidemill.sources.logs import Log, read_log
from tidemill.sources.tables import find, increment

QUERIES: dict[str, Registered] = {}
BASE = f"({READINGS.sql}) r"
NOW = f"TIMESTAMP '{AS_OF}'"


def _add(name, run, sql=None):
    QUERIES[name] = Registered(run, sql)


_add(
    "hourly_temperature_trend",
    lambda spark, sf: plan.hourly_trend(READINGS.df(spark, sf), AS_OF),
    f"""
    SELECT city, date_trunc('hour', event_time) AS hour_bucket,
           {rounded(mean('temperature_c'), 2)} AS avg_temp_c,
           {rounded('min(temperature_c)', 2)} AS min_temp_c, {rounded('max(temperature_c)', 2)} AS max_temp_c,
           {rounded(mean('humidity_pct'), 1)} AS avg_humidity,
           {rounded(total('precipitation_mm'), 2)} AS total_precip_mm, count(*) AS readings
    FROM {BASE} WHERE event_time >= {NOW} - INTERVAL 48 HOUR GROUP BY ALL
    """,
)

def _baseline_sql(as_of: str) -> str:
    now = f"TIMESTAMP '{as_of}'"
    return f"""
    WITH b AS (
        SELECT city AS baseline_city, sensor_id, {mean('temperature_c')} AS m, stddev_samp(temperature_c) AS sd
        FROM {BASE} WHERE event_time BETWEEN {now} - INTERVAL 7 DAY AND {now} - INTERVAL 1 HOUR GROUP BY ALL),
    l AS (
        SELECT sensor_id, city, temperature_c AS t FROM {BASE}
        QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY event_time DESC, city DESC) = 1)
    SELECT l.city, b.baseline_city, l.sensor_id, {rounded('l.t', 2)} AS current_temp_c,
           {rounded('b.m', 2)} AS baseline_temp_c, {rounded('b.sd', 2)} AS stddev_temp,
           {rounded('l.t - b.m', 2)} AS delta_temp, {rounded(ratio('l.t - b.m', 'b.sd'), 2)} AS z_score,
           CASE WHEN abs({ratio('l.t - b.m', 'b.sd')}) > 2 THEN 'ANOMALY' ELSE 'NORMAL' END AS status
    FROM l JOIN b ON l.sensor_id = b.sensor_id
    """


_add(
    "temperature_anomaly_vs_baseline",
    lambda spark, sf: plan.anomaly_vs_baseline(READINGS.df(spark, sf), AS_OF),
    _baseline_sql(AS_OF),
)


def _stored_baseline(as_of):
    """Each batch stores what it adds to its hours, split by day; the baseline is merged from them."""

    def run(spark, sf):
        rows, path = READINGS.df(spark, sf), new_folder(spark, "sensor-states")
        for batch in range(4):
            store_sensor_states(rows.where(F.col("batch_id") == batch), path, batch)
        return plan.anomaly_vs_stored_baseline(spark.read.parquet(path), rows, as_of)

    return run


# The second clock cuts hours at both ends of the baseline.
for _name, _as_of in (("temperature_anomaly_of_stored_hours", AS_OF), ("temperature_anomaly_between_hours", "2024-01-29 12:20:30")):
    _add(_name, _stored_baseline(_as_of), _baseline_sql(_as_of))

_add(
    "sensor_uptime_report",
    lambda spark, sf: quality.uptime_report(READINGS.df(spark, sf), AS_OF),
    f"""
    SELECT sensor_id, city, CAST(event_time AS DATE) AS report_date, count(*) AS total_events,
           count(*) FILTER (WHERE temperature_c IS NULL) AS null_temp_count,
           count(*) FILTER (WHERE humidity_pct IS NULL) AS null_humidity_count,
           {pct('temperature_c IS NOT NULL', 1)} AS temp_completeness_pct,
           min(event_time) AS first_event, max(event_time) AS last_event,
           date_sub('minute', min(event_time), max(event_time)) AS active_minutes
    FROM {BASE} WHERE event_time >= {NOW} - INTERVAL 24 HOUR GROUP BY ALL
    """,
)

_HOURLY_TABLE = f"""
    SELECT date_trunc('hour', event_time) AS hour_bucket, city, sensor_id,
           {rounded(mean('temperature_c'), 2)} AS avg_temp_c,
           {rounded('max(temperature_c)', 2)} AS max_temp_c, {rounded('min(temperature_c)', 2)} AS min_temp_c,
           {rounded(mean('humidity_pct'), 2)} AS avg_humidity_pct,
           {rounded(mean('wind_speed_kmh'), 2)} AS avg_wind_speed_kmh,
           {rounded(total('precipitation_mm'), 2)} AS total_precipitation_mm, count(*) AS event_count
    FROM {BASE} WHERE event_time >= {NOW} - INTERVAL 7 DAY GROUP BY ALL
"""


def _hourly_table(spark, sf):
    """Written as a date-partitioned Parquet table and read back."""
    table = plan.hourly_aggregates(READINGS.df(spark, sf), AS_OF)
    path = new_folder(spark, "sensor-hourly")
    write_files(table.withColumn("event_date", F.to_date("hour_bucket")), path, ["event_date"], ["city", "hour_bucket"])
    return spark.read.parquet(path).drop("event_date")


def _published_table(spark, sf):
    """Created or replaced as a catalog table partitioned by date."""
    table = plan.hourly_aggregates(READINGS.df(spark, sf), AS_OF)
    folder = new_folder(spark, "sensor_hourly")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    published = publish_table(table.withColumn("event_date", F.to_date("hour_bucket")), name, ["event_date"], folder)
    return published.drop("event_date")


_add("sensor_hourly_table", _hourly_table, _HOURLY_TABLE)
_add("sensor_hourly_catalog_table", _published_table, _HOURLY_TABLE)

_add(
    "reading_anomaly_flags",
    lambda spark, sf: plan.flag_anomalies(READINGS.df(spark, sf)).select(
        "event_id", "temperature_c", "is_anomaly"
    ),
    f"""
    WITH s AS (SELECT {mean('temperature_c')} AS m, stddev_samp(temperature_c) AS sd FROM {BASE})
    SELECT event_id, temperature_c,
           coalesce(abs(temperature_c - (SELECT m FROM s))
                    > 2 * coalesce(nullif((SELECT sd FROM s), 0), 1), FALSE) AS is_anomaly
    FROM {BASE}
    """,
)


def _windows_sql(keys: str) -> str:
    return f"""
    SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
           time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end, {keys},
           {mean('temperature_c')} AS avg_temp_c, min(temperature_c) AS min_temp_c,
           max(temperature_c) AS max_temp_c, {mean('humidity_pct')} AS avg_humidity_pct,
           {total('precipitation_mm')} AS total_precip_mm, count(*) AS reading_count
    FROM {BASE} GROUP BY ALL
    """


_add(
    "five_minute_windows_by_city",
    lambda spark, sf: plan.five_minute_windows(READINGS.df(spark, sf), ["city"]),
    _windows_sql("city"),
)
_add(
    "five_minute_windows_by_sensor",
    lambda spark, sf: plan.five_minute_windows(READINGS.df(spark, sf), ["sensor_id", "city"]),
    _windows_sql("sensor_id, city"),
)


def _merged_states(spark, sf):
    """Window states of each batch, merged afterwards."""
    states = plan.window_state(READINGS.df(spark, sf), ["city", "batch_id"])
    return plan.windows_of_states(states, ["city"])


_add("window_states_merged", _merged_states, _windows_sql("city"))

_add(
    "reading_quality_gate",
    lambda spark, sf: quality.reading_quality(READINGS.df(spark, sf), AS_OF),
    f"""
    SELECT *, CASE WHEN completeness_pct < 95 THEN 'incomplete' WHEN minutes_since_last_event > 90 THEN 'stale'
                   WHEN total_rows = 0 THEN 'empty' ELSE 'ok' END AS verdict
    FROM (
        SELECT count(*) AS total_rows, count(*) FILTER (WHERE temperature_c IS NULL) AS null_temp,
               count(*) FILTER (WHERE humidity_pct IS NULL) AS null_humidity,
               {pct('temperature_c IS NOT NULL', 2)} AS completeness_pct, max(event_time) AS latest_event,
               date_sub('minute', max(event_time), {NOW}) AS minutes_since_last_event
        FROM {BASE} WHERE event_time >= {NOW} - INTERVAL 3 HOUR)
    """,
)

# -- the log: text records written and read back --------------------------------


def _log(spark, sf):
    """Readings as a log of JSON text; some records are cut off, some lack the sensor."""
    rows = READINGS.df(spark, sf)
    sent = rows.select(
        F.when(F.col("event_id") % 71 == 5, None).otherwise(F.col("sensor_id")).alias("sensor_id"),
        "city", "latitude", "longitude", "temperature_c", "humidity_pct", "precipitation_mm", "wind_speed_kmh",
        "wind_direction_deg", F.col("event_time").cast("string").alias("event_time"), F.lit("api").alias("source"),
        "event_id",
    )
    text = encode(sent.drop("event_id")).schema  # the log holds one text column
    record = F.to_json(F.struct(*[c for c in sent.columns if c != "event_id"]))
    broken = F.col("event_id") % 100 == 7
    log = sent.select(F.when(broken, F.substring(record, 1, 25)).otherwise(record).alias(text.names[0]))
    path = new_folder(spark, "sensor-log")
    log.write.text(path)
    return read_log(spark, Log(path, "text"))


_add(
    "decoded_reading_log",
    lambda spark, sf: plan.decode_readings(_log(spark, sf)).withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz")
    ),
    f"""
    SELECT sensor_id, city, latitude, longitude, temperature_c, humidity_pct, precipitation_mm, wind_speed_kmh,
           wind_direction_deg, event_time
    FROM {BASE} WHERE event_id % 100 <> 7 AND event_id % 71 <> 5
    """,
)

_add(
    "reading_log_rejects",
    lambda spark, sf: decode_with_rejects(_log(spark, sf), schemas.SENSOR_READING)
    .groupBy(F.col(REJECT).alias("rejected"))
    .agg(F.count(F.lit(1)).alias("records")),
    f"""
    SELECT CASE WHEN event_id % 100 = 7 THEN
               substr(CASE WHEN event_id % 71 = 5 THEN '{{"city":"' || city || '","latitude":' || latitude || ','
                      ELSE '{{"sensor_id":"' || sensor_id || '","city":"' || city || '","lat' END, 1, 25)
           END AS rejected, count(*) AS records
    FROM {BASE} GROUP BY 1
    """,
)

_add(
    "event_props_decoded",
    lambda spark, sf: spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id",
        F.from_json("props", "k INT")["k"].alias("k"),
        nested_or("props", "$.missing", "NONE").alias("missing"),
        F.to_json(F.struct("event_type", F.nullif(F.col("user_id") % 2, F.lit(0)).alias("odd"))).alias("as_json"),
    ),
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, 'NONE' AS missing,
           CASE WHEN user_id % 2 = 0 THEN '{"event_type":"' || event_type || '"}'
                ELSE '{"event_type":"' || event_type || '","odd":1}' END AS as_json
    FROM events
    """,
)

# -- increments and marks ---------------------------------------------------------



def _text(flag):
    """A three-valued flag as text."""
    return F.col(flag).cast("string").alias(flag)


_TWO_DAYS = f"event_time >= {NOW} - INTERVAL 48 HOUR"

# The cap is the operator here: the oldest rows up to a number per run.
_add(
    "unsynced_increment_oldest_first",
    lambda spark, sf: increment(
        READINGS.df(spark, sf), "event_time", "event_id", synced="synced",
        not_before=before(AS_OF, "20 DAY"), cap=1000,
    ).select("event_id", "sensor_id", "event_time", _text("synced")),
    f"""
    SELECT event_id, sensor_id, event_time, CAST(synced AS VARCHAR) AS synced FROM {BASE}
    WHERE NOT coalesce(synced, FALSE) AND event_time >= {NOW} - INTERVAL 20 DAY
    ORDER BY event_time, event_id LIMIT 1000
    """,
)

_add(
    "increment_after_mark",
    lambda spark, sf: increment(
        READINGS.df(spark, sf), "event_time", "event_id", after=("2024-01-20 12:00:00", 100)
    ).select("event_id", "sensor_id", "event_time"),
    f"""
    SELECT event_id, sensor_id, event_time FROM {BASE}
    WHERE event_time > TIMESTAMP '2024-01-20 12:00:00'
       OR (event_time = TIMESTAMP '2024-01-20 12:00:00' AND event_id > 100)
    """,
)

_add(
    "new_records_branch",
    lambda spark, sf: increment(
        READINGS.df(spark, sf), "event_time", "event_id", synced="synced", not_before=before(AS_OF, "2 HOUR")
    ).agg(F.count(F.lit(1)).alias("unsynced"), (F.count(F.lit(1)) > 0).alias("has_new")),
    f"""
    SELECT count(*) AS unsynced, count(*) > 0 AS has_new FROM {BASE}
    WHERE NOT coalesce(synced, FALSE) AND event_time >= {NOW} - INTERVAL 2 HOUR
    """,
)


def _synced(spark, sf):
    """Incremental export into a folder, then exactly the exported rows are marked."""
    stored = READINGS.df(spark, sf).select("event_id", "sensor_id", "event_time", "temperature_c", "synced")
    after = export_increment(
        stored, new_folder(spark, "export"), "run-1", ["event_id"], "event_time",
        real=["temperature_c"], not_before=before(AS_OF, "48 HOUR"),
    )
    return after.select("event_id", _text("synced"))


_add(
    "synced_after_export",
    _synced,
    f"""
    SELECT event_id, CAST(CASE WHEN NOT coalesce(synced, FALSE) AND {_TWO_DAYS} THEN TRUE ELSE synced END
           AS VARCHAR) AS synced
    FROM {BASE}
    """,
)



def _synced_runs(spark, sf):
    """A run before some rows have arrived, two runs after; the last finds nothing."""
    folder, rows = new_folder(spark, "sync"), READINGS.df(spark, sf).select("event_id", "event_time")
    early = rows.where("event_id % 3 <> 0")
    for run_id, seen in (("run-1", early), ("run-2", rows), ("run-2", rows), ("run-3", rows)):
        sync(spark, seen, folder, run_id, ["event_id"], ["event_time"])
    return spark.read.parquet(f"{folder}/export")


_add(
    "synced_with_stored_marks",
    _synced_runs,
    f"""
    SELECT event_id, event_time, CASE WHEN event_id % 3 <> 0 THEN 'run-1' ELSE 'run-2' END AS run_id FROM {BASE}
    """,
)

SLICES = {"event_date": "date", "batch_id": "int"}


def _synced_slices(spark, sf):
    """A table split by day and batch; later batches bring late rows of all days, the last run finds nothing."""
    rows = READINGS.df(spark, sf).select("event_id", "event_time", "batch_id", F.to_date("event_time").alias("event_date"))
    source, folder = new_folder(spark, "stored"), new_folder(spark, "slices")
    for run_id, batches in (("run-1", (0, 1)), ("run-2", (2, 3)), ("run-3", ())):
        if batches:
            replace_slice(rows.where(F.col("batch_id").isin(*batches)), source, list(SLICES))
        sync_slices(spark, source, folder, run_id, SLICES, ["event_time"])
    return spark.read.parquet(f"{folder}/export").select("event_id", "event_time", "batch_id", "run_id")


_add(
    "synced_by_slices",
    _synced_slices,
    f"""
    SELECT event_id, event_time, batch_id, CASE WHEN batch_id < 2 THEN 'run-1' ELSE 'run-2' END AS run_id FROM {BASE}
    """,
)

_add(
    "rows_marked_synced",
    lambda spark, sf: mark(
        READINGS.df(spark, sf).select("event_id", "synced"),
        READINGS.df(spark, sf).where(F.col("temperature_c") > 100).select("event_id"),
        ["event_id"],
    ).select("event_id", _text("synced")),
    f"""
    SELECT event_id, CAST(CASE WHEN temperature_c > 100 THEN TRUE ELSE synced END AS VARCHAR) AS synced
    FROM {BASE}
    """,
)

_add(
    "duplicate_sensor_hours",
    lambda spark, sf: duplicate_keys(
        READINGS.df(spark, sf).withColumn("hour", F.date_trunc("hour", "event_time").cast("timestamp_ntz")),
        ["sensor_id", "hour"],
    ),
    f"""
    SELECT sensor_id, date_trunc('hour', event_time) AS hour, count(*) AS copies
    FROM {BASE} GROUP BY ALL HAVING count(*) > 1
    """,
)


def _exported(spark, sf):
    """Rows under the export contract: declared columns only, cast, missing ones NULL."""
    path = new_folder(spark, "exported")
    write_files(conform(READINGS.df(spark, sf), schemas.EXPORTED_READING), path)
    return spark.read.parquet(path).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


_add(
    "exported_readings",
    _exported,
    f"""
    SELECT sensor_id, city, latitude, longitude, event_time, temperature_c, humidity_pct,
           CAST(NULL AS DOUBLE) AS apparent_temp_c, precipitation_mm, weather_code, wind_speed_kmh,
           wind_direction_deg, CAST(NULL AS VARCHAR) AS ingestion_source
    FROM {BASE}
    """,
)

_add(
    "found_documents",
    lambda spark, sf: find(
        READINGS.df(spark, sf), (F.col("city") == "click") & (F.col("temperature_c") >= 50),
        ["event_id", "sensor_id", "temperature_c", "batch_id"], exclude=["batch_id"],
    ),
    f"SELECT event_id, sensor_id, temperature_c FROM {BASE} WHERE city = 'click' AND temperature_c >= 50",
)
