"""Registered queries over repositories, daily weather, payloads and loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemill.functions import records
from tidemill.functions import time as time_fn
from tidemill.operators import quality
from tidemill.operators.dedup import any_per_key, latest_per_key
from tidemill.operators.rollups import union_all
from tidemill.plans import loads
from tidemill.plans import repositories as repos_plan
from tidemill.plans import weather as weather_plan
from tidemill.registered.base import (
    AS_OF, DAILY, DAILY_WEATHER, REPOS, Registered, mean, ratio, rounded, table, total,
)
from tidemill.session import new_folder
from tidemill.sinks.tables import (
    REJECTED, Target, append, conform, counted, expire, load_staged, overwrite, replace_slice, retained, upper_names,
    write_files,
)
from tidemill.sinks.expiry import alive, expire_rows, store_expiring, with_expiry
from tidemill.sinks.unique import KeyConflict, load_unique
from tidemill.sources.tables import scan_external, slice_of

QUERIES: dict[str, Registered] = {}
NOW = f"TIMESTAMP '{AS_OF}'"


def _add(name, run, sql=None):
    QUERIES[name] = Registered(run, sql)


# -- repositories -----------------------------------------------------------------


def _repos(spark, sf):
    return repos_plan.repository_features(REPOS.df(spark, sf), AS_OF)


def _features_sql(rate: str) -> str:
    return f"""
    SELECT repo_id, repo_name, lower(trim(language)) AS language, stars, forks, watchers,
           coalesce(license, 'UNLICENSED') AS license, TRY_CAST(created_at AS TIMESTAMP) AS created_at,
           CAST(coalesce(date_diff('day', TRY_CAST(created_at AS DATE), DATE '2024-01-31'), -1) AS INT)
               AS repo_age_days,
           {rounded('CAST(stars AS DOUBLE) * CAST(0.5 AS DOUBLE) + CAST(forks AS DOUBLE) * CAST(0.3 AS DOUBLE)'
                    ' + CAST(watchers AS DOUBLE) * CAST(0.2 AS DOUBLE)', 2)} AS activity_score,
           {rate} AS stars_per_day, DATE '2024-01-31' AS batch_date
    FROM ({REPOS.sql}) WHERE stars > 0
    """


# An unknown age counts as one day: GREATEST skips NULL.
_AGE = "date_diff('day', TRY_CAST(created_at AS DATE), DATE '2024-01-31')"
_FLOOR = rounded(ratio("stars", f"greatest(coalesce({_AGE}, 1), 1)"), 4)
_SHIFT = rounded(ratio("stars", f"{_AGE} + 1"), 2)


def _feature_columns(df):
    """Unknown ages as -1, so that the column is a plain integer in both engines."""
    return df.withColumns(
        {
            "created_at": F.col("created_at").cast("timestamp_ntz"),
            "repo_age_days": F.coalesce("repo_age_days", F.lit(-1)),
        }
    ).drop("ingested_at")


_add("repository_features", lambda spark, sf: _feature_columns(_repos(spark, sf)), _features_sql(_FLOOR))
_add(
    "repository_features_shifted_age",
    lambda spark, sf: _feature_columns(
        repos_plan.repository_features(REPOS.df(spark, sf), AS_OF, young_age="shift")
    ),
    _features_sql(_SHIFT),
)
_add(
    "top_repositories_by_language",
    lambda spark, sf: repos_plan.top_by_language(_repos(spark, sf), dt.date(2024, 1, 31)),
    f"""
    SELECT language, count(*) AS repo_count, {rounded(mean('stars'), 0)} AS avg_stars,
           {rounded(mean('stars_per_day'), 2)} AS avg_stars_per_day,
           {rounded(mean('activity_score'), 2)} AS avg_activity_score, max(stars) AS max_stars,
           count(*) FILTER (WHERE license = 'UNLICENSED') AS unlicensed_count
    FROM ({_features_sql(_FLOOR)}) WHERE batch_date = DATE '2024-01-31' GROUP BY language
    """,
)
_add(
    "repositories_ingested_over_time",
    lambda spark, sf: repos_plan.ingested_over_time(
        REPOS.df(spark, sf).withColumn("batch_date", F.col("batch_date").cast("date"))
    ),
    f"""
    SELECT CAST(batch_date AS DATE) AS batch_date, language, count(*) AS repos_ingested,
           {rounded(mean('stars'), 0)} AS avg_stars
    FROM ({REPOS.sql}) GROUP BY ALL
    """,
)

# -- weather ------------------------------------------------------------------------

_WEATHER_SQL = f"""
    SELECT city, CAST(date AS DATE) AS date, temp_max_c, temp_min_c, temp_mean_c, precipitation_mm,
           wind_speed_max_kmh, solar_radiation_sum, ingested_at,
           {rounded('temp_max_c - temp_min_c', 2)} AS temp_range_c,
           coalesce(precipitation_mm > 1, FALSE) AS is_rainy, DATE '2024-01-31' AS batch_date
    FROM ({DAILY_WEATHER.sql}) WHERE ingested_at = TIMESTAMP '2024-01-30 02:00:00'
"""


def _weather(spark, sf):
    return weather_plan.weather_features(DAILY_WEATHER.df(spark, sf), AS_OF).withColumn(
        "ingested_at", F.col("ingested_at").cast("timestamp_ntz")
    )


_add("weather_features", _weather, _WEATHER_SQL)
_add(
    "weather_summary",
    lambda spark, sf: weather_plan.summary(_weather(spark, sf), AS_OF),
    f"""
    SELECT city, count(*) AS days_recorded, {rounded(mean('temp_mean_c'), 2)} AS avg_temp_c,
           {rounded('max(temp_max_c)', 2)} AS highest_temp_c, {rounded('min(temp_min_c)', 2)} AS lowest_temp_c,
           {rounded(total('precipitation_mm'), 1)} AS total_rain_mm,
           count(*) FILTER (WHERE is_rainy) AS rainy_days,
           {rounded(mean('wind_speed_max_kmh'), 1)} AS avg_max_wind_kmh,
           {rounded(mean('solar_radiation_sum'), 1)} AS avg_solar_mj_m2
    FROM ({_WEATHER_SQL}) WHERE date >= DATE '2024-01-31' - 30 GROUP BY city
    """,
)
_add(
    "weather_weekly_trend",
    lambda spark, sf: weather_plan.weekly_trend(_weather(spark, sf)),
    f"""
    SELECT city, CAST(date_trunc('week', date) AS DATE) AS week_start,
           {rounded(mean('temp_mean_c'), 2)} AS avg_temp_c, {rounded('max(temp_max_c)', 2)} AS max_temp_c,
           {rounded(total('precipitation_mm'), 2)} AS weekly_rain_mm,
           count(*) FILTER (WHERE is_rainy) AS rainy_days_in_week
    FROM ({_WEATHER_SQL}) GROUP BY ALL
    """,
)

# -- payloads -------------------------------------------------------------------------
# The payloads are built from the tables, so the flattened rows have a plain twin.


def _weather_payloads(spark, sf):
    """One response per city with parallel daily arrays; the last one is a day short.

    A response holds one entry per day, so a city's arrays are bounded by the calendar.
    """
    days = DAILY.df(spark, sf).groupBy("city").agg(
        F.array_sort(F.collect_list(F.struct("day", "hi", "lo", "n"))).alias("d")
    )
    wind = F.transform("d", lambda x: x["n"].cast("double"))
    daily = F.struct(
        F.transform("d", lambda x: x["day"].cast("string")).alias("time"),
        F.transform("d", lambda x: x["hi"]).alias("temperature_2m_max"),
        F.transform("d", lambda x: x["lo"]).alias("temperature_2m_min"),
        F.slice(wind, F.lit(1), F.size("d") - 1).alias("wind_speed_10m_max"),
    )
    return days.select(F.to_json(F.struct("city", daily.alias("daily"))).alias("value"))


_add(
    "weather_payload_rows",
    lambda spark, sf: records.weather_rows(_weather_payloads(spark, sf)),
    f"""
    SELECT city, CAST(day AS VARCHAR) AS date, hi AS temp_max_c, lo AS temp_min_c,
           CAST(NULL AS DOUBLE) AS temp_mean_c, CAST(NULL AS DOUBLE) AS precipitation_mm,
           CASE WHEN day < max(day) OVER (PARTITION BY city) THEN CAST(n AS DOUBLE) END AS wind_speed_max_kmh
    FROM ({DAILY.sql})
    """,
)


def _candle_payloads(spark, sf):
    """One response per key with [ms, open, high, low, close] per day (bounded by the calendar)."""
    days = DAILY.df(spark, sf)
    ms = F.unix_date("day") * F.lit(86_400_000.0)
    return (
        days.groupBy(F.col("city").alias("coin_id"))
        .agg(F.collect_list(F.array(ms, "lo", "hi", "lo", "hi")).alias("candles"))
        .select(F.to_json(F.struct("coin_id", "candles")).alias("value"))
    )


_add(
    "candle_payload_rows",
    lambda spark, sf: records.candle_rows(_candle_payloads(spark, sf)),
    f"""
    SELECT city AS coin_id, day AS candle_date, CAST(epoch_ms(CAST(day AS TIMESTAMP)) AS DOUBLE) AS timestamp_ms,
           lo AS open, hi AS high, lo AS low, hi AS close, {rounded('hi - lo', 6)} AS price_range,
           hi >= lo AS is_bullish
    FROM ({DAILY.sql})
    """,
)


def _indicator_payloads(spark, sf):
    """One ``[meta, [items]]`` response per customer; negative balances have no value."""
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    item = F.struct(
        F.struct(F.concat(F.lit("n"), F.col("n_nationkey")).alias("id"), F.col("n_name").alias("value")).alias(
            "country"
        ),
        F.struct(F.lit("BAL").alias("id"), F.lit("balance").alias("value")).alias("indicator"),
        (F.col("c_custkey") % 30 + 1990).cast("string").alias("date"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("value"),
    )
    meta = F.to_json(F.struct(F.lit(1).alias("page"), F.col("c_custkey").alias("total")))
    items = F.to_json(F.array(item, item), {"ignoreNullFields": "false"})
    return rows.select(F.concat(F.lit("["), meta, F.lit(","), items, F.lit("]")).alias("value"))


_add(
    "indicator_payload_rows",
    lambda spark, sf: records.indicator_rows(_indicator_payloads(spark, sf)),
    """
    SELECT 'n' || n_nationkey AS country_code, n_name AS country_name, 'BAL' AS indicator_code,
           'balance' AS indicator_name, CAST(c_custkey % 30 + 1990 AS INT) AS year, c_acctbal AS value
    FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer) JOIN nation ON c_nationkey = n_nationkey
    WHERE c_acctbal >= 0
    """,
)


def _repository_payloads(spark, sf):
    p = table(spark, sf, "part")
    key = F.col("p_partkey")
    item = F.struct(
        key.alias("id"),
        F.col("p_name").alias("full_name"),
        F.when(key % 3 == 0, F.repeat("p_name", 100)).alias("description"),
        F.col("p_size").alias("stargazers_count"),
        F.lit(3).alias("forks_count"),
        F.lit(2).alias("watchers_count"),
        F.when(key % 5 != 0, F.struct(F.col("p_type").alias("spdx_id"))).alias("license"),
        F.when(key % 2 == 0, F.split("p_name", " ")).alias("topics"),
    )
    return p.select(F.to_json(item).alias("value"))


_add(
    "repository_payload_rows",
    lambda spark, sf: records.repository_rows(_repository_payloads(spark, sf)),
    """
    SELECT p_partkey AS repo_id, p_name AS repo_name,
           CASE WHEN p_partkey % 3 = 0 THEN repeat(p_name, 100) ELSE '' END AS description,
           p_size AS stars, 3 AS forks, 2 AS watchers,
           CASE WHEN p_partkey % 5 <> 0 THEN p_type ELSE 'NONE' END AS license,
           CASE WHEN p_partkey % 2 = 0 THEN replace(p_name, ' ', ',') ELSE '' END AS topics,
           CAST(NULL AS VARCHAR) AS created_at
    FROM part
    """,
)

# -- duplicates, slices, audit ----------------------------------------------------------

_add(
    "latest_order_per_customer",
    lambda spark, sf: latest_per_key(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]),
    """
    SELECT * FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
)


def _any_lines(spark, sf):
    """The survivor of each order, whichever it is, is one of the order's lines."""
    lines = table(spark, sf, "lineitem")
    one = any_per_key(lines, ["l_orderkey"])
    own = lines.groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("numbers"))
    return one.join(own, "l_orderkey").select(
        "l_orderkey", F.array_contains("numbers", F.col("l_linenumber")).alias("is_own_line")
    )


_add("any_line_per_order", _any_lines, "SELECT DISTINCT l_orderkey, TRUE AS is_own_line FROM lineitem")

_STAGED_DDL = "repo_id BIGINT, language STRING, stars INT, batch_date DATE"


def _warehouse_slices(spark, sf):
    """Two daily slices staged as Parquet and loaded; one of them loaded twice."""
    staged, target = new_folder(spark, "staged"), new_folder(spark, "warehouse")
    write_files(REPOS.df(spark, sf), staged, ["batch_date"])
    load_staged(spark, staged, target, _STAGED_DDL, ["batch_date"])
    again = spark.read.parquet(staged).withColumn("batch_date", F.col("batch_date").cast("date"))
    loads.load_slice(
        spark, again.withColumn("stars", F.col("stars") + 100), target, dt.date(2024, 1, 30), _STAGED_DDL
    )
    return upper_names(spark.read.parquet(target))


_add(
    "warehouse_slice_replaced",
    _warehouse_slices,
    f"""
    SELECT repo_id AS "REPO_ID", language AS "LANGUAGE",
           CASE WHEN batch_date = '2024-01-30' THEN stars + 100 ELSE stars END AS "STARS",
           CAST(batch_date AS DATE) AS "BATCH_DATE"
    FROM ({REPOS.sql})
    """,
)

_add(
    "batch_slice",
    lambda spark, sf: slice_of(REPOS.df(spark, sf), "batch_date", "2024-01-30").select("repo_id", "stars"),
    f"SELECT repo_id, stars FROM ({REPOS.sql}) WHERE batch_date = '2024-01-30'",
)


def _audit(spark, sf):
    """Write counts observed while loading, upserted per job and day; the day runs twice."""
    repos = REPOS.df(spark, sf)
    audit, day = new_folder(spark, "audit"), dt.date(2024, 1, 31)
    for attempt in (1, 2):
        extracted = counted(lambda seen: write_files(repos, new_folder(spark, "extracted"), seen=seen))["rows"]
        kept = repos.where(F.col("stars") > 10 * (attempt - 1))
        staged = counted(
            lambda seen: write_files(kept, new_folder(spark, "staged"), ["batch_date"], seen=seen),  # noqa: B023
            most=F.max("stars"),
        )["rows"]
        loads.log_run(
            spark, audit, "repositories", day, extracted, staged, staged, dt.datetime(2024, 1, 31, attempt)
        )
    return spark.read.parquet(audit).select(
        "dag_id", "execution_date", "records_extracted", "records_staged", "records_loaded", "status"
    )


_add(
    "audit_upserted",
    _audit,
    f"""
    SELECT 'repositories' AS dag_id, DATE '2024-01-31' AS execution_date, count(*) AS records_extracted,
           count(*) FILTER (WHERE stars > 10) AS records_staged,
           count(*) FILTER (WHERE stars > 10) AS records_loaded, 'SUCCESS' AS status
    FROM ({REPOS.sql})
    """,
)
_add(
    "stage_reconciliation",
    lambda spark, sf: quality.reconcile(
        REPOS.df(spark, sf), REPOS.df(spark, sf).where("stars > 0"), REPOS.df(spark, sf).where("stars > 0"),
        "batch_date",
    ),
    f"""
    SELECT batch_date, count(*) AS records_extracted, count(*) FILTER (WHERE stars > 0) AS records_staged,
           count(*) FILTER (WHERE stars > 0) AS records_loaded,
           CASE WHEN count(*) = count(*) FILTER (WHERE stars > 0) THEN 'SUCCESS' ELSE 'MISMATCH' END AS status
    FROM ({REPOS.sql}) GROUP BY batch_date
    """,
)


def _connector_writes(spark, sf):
    """Overwrite, then append, through the connector writer, and read back the same way."""
    target = Target.folder(new_folder(spark, "connector"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    overwrite(lines.where("l_linenumber > 2"), target)
    overwrite(lines.where("l_linenumber <= 2"), target)
    append(lines.where("l_linenumber > 2"), target)
    return scan_external(spark, target.format, target.options)


_add(
    "connector_overwrite_and_append",
    _connector_writes,
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
)


def _retained(spark, sf):
    """Series partitioned by day, reduced to its time to live."""
    path = new_folder(spark, "series")
    events = table(spark, sf, "events").select("event_id", "ts", F.to_date("ts").alias("day"))
    replace_slice(events, path, ["day"], ["ts"])
    return retained(spark.read.parquet(path), "ts", AS_OF, 7).select("event_id", "ts")


_add(
    "series_within_time_to_live",
    _retained,
    f"SELECT event_id, ts FROM events WHERE ts >= {NOW} - INTERVAL 7 DAY",
)


_DAYS_TO_LIVE = "3 + user_id % 20"


def _row_expiry(spark, sf):
    """Rows with a time to live of their own, some without a time: they live from when they were written."""
    path, written = new_folder(spark, "expiring"), "2024-01-20 06:30:00"
    rows = table(spark, sf, "events").select("event_id", "user_id", F.expr("if(event_id % 40 = 0, NULL, ts)").alias("ts"))
    store_expiring(with_expiry(rows, "ts", F.expr(_DAYS_TO_LIVE), written), path)
    expire_rows(spark, path, dt.date(2024, 1, 31))
    return alive(spark.read.parquet(path), AS_OF).select("event_id", "ts")


_add(
    "series_with_row_expiry",
    _row_expiry,
    f"""
    SELECT event_id, CASE WHEN event_id % 40 <> 0 THEN ts END AS ts FROM events
    WHERE CASE WHEN event_id % 40 = 0 THEN TIMESTAMP '2024-01-20 06:30:00' ELSE ts END
          + INTERVAL 1 DAY * CAST({_DAYS_TO_LIVE} AS INT) > {NOW}
    """,
)


def _unique_loads(spark, sf):
    """Two loads that share keys, under each rule; the refused one leaves the table as it was."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    first = orders.where("o_orderkey % 3 <> 0")
    second = orders.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.lit(-1.0))
    out = []
    for rule in ("fail", "ignore", "replace"):
        path = new_folder(spark, f"unique-{rule}")
        load_unique(spark, path, first, ["o_orderkey"], "first", rule)
        try:
            for _ in range(2):  # a load that is run again changes nothing
                load_unique(spark, path, second, ["o_orderkey"], "second", rule)
        except KeyConflict:
            pass
        out.append(spark.read.parquet(path).withColumn("rule", F.lit(rule)))
    return union_all(*out)


_add(
    "orders_loaded_uniquely",
    _unique_loads,
    """
    WITH f AS (SELECT o_orderkey, o_totalprice, 'first' AS load_id FROM orders WHERE o_orderkey % 3 <> 0),
    s AS (SELECT o_orderkey, CAST(-1 AS DOUBLE) AS o_totalprice, 'second' AS load_id FROM orders WHERE o_orderkey % 2 = 0)
    SELECT *, 'fail' AS rule FROM f
    UNION ALL SELECT *, 'ignore' FROM f
    UNION ALL SELECT *, 'ignore' FROM s WHERE o_orderkey % 3 = 0
    UNION ALL SELECT *, 'replace' FROM s
    UNION ALL SELECT *, 'replace' FROM f WHERE o_orderkey % 2 <> 0
    """,
)


def _stored_decimals(spark, sf):
    """Rows under the stored contract with exact numeric types."""
    path = new_folder(spark, "stored")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("code"), F.col("o_orderkey").alias("small"),
    )
    write_files(conform(orders, "order_id BIGINT, price DECIMAL(8,2), code STRING, small SMALLINT"), path)
    return spark.read.parquet(path).select(
        "order_id", (F.col("price") * 100).cast("bigint").alias("cents"), "code", F.col("small").cast("int")
    )


_add(
    "stored_decimal_contract",
    _stored_decimals,
    """
    SELECT o_orderkey AS order_id, CAST(CAST(o_totalprice AS DECIMAL(8,2)) * 100 AS BIGINT) AS cents,
           o_orderpriority AS code, CAST(TRY_CAST(o_orderkey AS SMALLINT) AS INT) AS small
    FROM orders
    """,
)


def _rejects(spark, sf):
    """What the contract above cannot hold, by column."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("small")
    )
    rows = conform(orders, "order_id BIGINT, price DECIMAL(8,2), small SMALLINT", rejects=True)
    return rows.select("order_id", F.array_join(REJECTED, ",").alias("rejected"))


_add(
    "contract_rejects",
    _rejects,
    """
    SELECT o_orderkey AS order_id, concat_ws(',', CASE WHEN o_totalprice >= 999999.995 THEN 'price' END,
           CASE WHEN o_orderkey > 32767 THEN 'small' END) AS rejected
    FROM orders
    """,
)


def _slice_emptied(spark, sf):
    """Two days loaded; the second load of one of them has no rows."""
    target = new_folder(spark, "emptied")
    repos = REPOS.df(spark, sf).withColumn("batch_date", F.col("batch_date").cast("date"))
    days = [dt.date(2024, 1, 30), dt.date(2024, 1, 31)]
    counts = [loads.load_slice(spark, repos, target, day, _STAGED_DDL) for day in days]
    counts.append(loads.load_slice(spark, repos.where("batch_date > DATE '2024-01-30'"), target, days[0], _STAGED_DDL))
    return spark.read.parquet(target).select("repo_id", "stars", "batch_date", F.lit(counts[-1]).cast("int").alias("last"))


_add(
    "warehouse_slice_emptied",
    _slice_emptied,
    f"""
    SELECT repo_id, stars, CAST(batch_date AS DATE) AS batch_date, CAST(0 AS INT) AS last
    FROM ({REPOS.sql}) WHERE batch_date = '2024-01-31'
    """,
)


def _expired(spark, sf):
    """The series after the expiry job: whole day folders are gone."""
    path = new_folder(spark, "expired")
    replace_slice(table(spark, sf, "events").select("event_id", "ts", F.to_date("ts").alias("day")), path, ["day"], ["ts"])
    expire(spark, path, "day", dt.date(2024, 1, 31), 7)
    return spark.read.parquet(path).select("event_id", "ts")


_add(
    "series_after_expiry",
    _expired,
    "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-24'",
)
_add(
    "numbers_from_text",
    lambda spark, sf: loads.coerce_numbers(
        table(spark, sf, "part").select(
            "p_partkey",
            F.when(F.col("p_partkey") % 4 == 0, F.concat("p_size", F.lit("x"))).otherwise(
                F.when(F.col("p_partkey") % 4 != 1, F.col("p_size").cast("string"))
            ).alias("score"),
            F.when(F.col("p_partkey") % 3 > 0, F.col("p_retailprice").cast("string")).alias("ratio"),
        ),
        whole=["score", "absent"], real=["ratio"],
    ),
    """
    SELECT p_partkey, CASE WHEN p_partkey % 4 IN (2, 3) THEN p_size ELSE 0 END AS score,
           CASE WHEN p_partkey % 3 > 0 THEN p_retailprice ELSE 0 END AS ratio
    FROM part
    """,
)



def _utc(moment):
    """The wall clock in UTC, whatever the session's time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))


_add(
    "times_from_epochs",
    lambda spark, sf: table(spark, sf, "events").select(
        "event_id",
        _utc(time_fn.from_epoch(seconds=F.col("event_id") + 1700000000)).alias("from_seconds"),
        _utc(time_fn.from_epoch(millis=F.col("event_id") * 1000 + 1700000000123)).cast("date").alias("from_millis"),
        time_fn.minutes_between(F.col("ts"), time_fn.clock(AS_OF)).alias("minutes_ago"),
        time_fn.iso_hour("ts").alias("iso_hour"),
    ),
    f"""
    SELECT event_id, epoch_ms((event_id + 1700000000) * 1000)::TIMESTAMP AS from_seconds,
           CAST(epoch_ms(event_id * 1000 + 1700000000123) AS DATE) AS from_millis,
           date_sub('minute', ts, {NOW}) AS minutes_ago, strftime(ts, '%Y-%m-%dT%H:00:00Z') AS iso_hour
    FROM events
    """,
)


def _by_position(spark, sf):
    """Plain SQL: grouping by ordinal and by alias, mixed sort directions."""
    return spark.sql(
        """
        SELECT date_trunc('HOUR', ts)::TIMESTAMP_NTZ AS hour_bucket, event_type, count(*) AS n,
               count(CASE WHEN value > 50 THEN 1 END) AS large
        FROM {events} GROUP BY 1, 2 HAVING count(*) >= 3 ORDER BY event_type, hour_bucket DESC
        """,
        events=table(spark, sf, "events"),
    )


_add(
    "hourly_counts_by_position",
    _by_position,
    """
    SELECT date_trunc('hour', ts) AS hour_bucket, event_type, count(*) AS n,
           count(CASE WHEN value > 50 THEN 1 END) AS large
    FROM events GROUP BY 1, 2 HAVING count(*) >= 3
    """,
)
