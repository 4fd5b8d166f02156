"""Declared record contracts, as DDL.  Schemas are fixed, never inferred."""

# Field names and types of the published records.

SENSOR_READING = """
    sensor_id STRING, city STRING, latitude DOUBLE, longitude DOUBLE,
    temperature_c DOUBLE, humidity_pct DOUBLE, precipitation_mm DOUBLE,
    wind_speed_kmh DOUBLE, wind_direction_deg DOUBLE, event_time TIMESTAMP
"""

# Stored form of a reading; the exact numeric types belong to the table.
STORED_READING = """
    sensor_id STRING, city STRING, latitude DECIMAL(9,6), longitude DECIMAL(9,6),
    event_time TIMESTAMP, temperature_c DECIMAL(5,2), humidity_pct DECIMAL(5,2),
    apparent_temp_c DECIMAL(5,2), precipitation_mm DECIMAL(6,2), weather_code SMALLINT,
    wind_speed_kmh DECIMAL(6,2), wind_direction_deg DECIMAL(5,2), ingestion_source STRING
"""

# Exported form of a reading (analytics table, floating point).
EXPORTED_READING = """
    sensor_id STRING, city STRING, latitude DOUBLE, longitude DOUBLE,
    event_time TIMESTAMP, temperature_c DOUBLE, humidity_pct DOUBLE,
    apparent_temp_c DOUBLE, precipitation_mm DOUBLE, weather_code INT,
    wind_speed_kmh DOUBLE, wind_direction_deg DOUBLE, ingestion_source STRING
"""

# repo_id is BIGINT: ids above 2^31 exist and an INT field would decode to NULL.
REPOSITORY = """
    repo_id BIGINT, repo_name STRING, name STRING, full_name STRING,
    description STRING, language STRING, stars INT, forks INT, open_issues INT,
    watchers INT, is_fork BOOLEAN, license STRING, created_at STRING,
    updated_at STRING, pushed_at STRING, size_kb INT, topics STRING,
    html_url STRING, batch_date STRING, ingested_at TIMESTAMP
"""

DAILY_WEATHER = """
    city STRING, date STRING, temp_max_c DOUBLE, temp_min_c DOUBLE,
    temp_mean_c DOUBLE, precipitation_mm DOUBLE, rain_sum_mm DOUBLE,
    wind_speed_max_kmh DOUBLE, wind_gusts_max_kmh DOUBLE,
    wind_direction_dominant_deg DOUBLE, solar_radiation_sum DOUBLE,
    batch_date STRING, ingested_at TIMESTAMP
"""

FORUM_POST = """
    post_id STRING, subreddit STRING, title STRING, body STRING, author STRING,
    score INT, upvote_ratio DOUBLE, num_comments INT, url STRING,
    is_self BOOLEAN, flair STRING, created_utc TIMESTAMP, ingested_at TIMESTAMP
"""

COUNTRY_INDICATOR = """
    country_code STRING, country_name STRING, indicator_code STRING,
    indicator_name STRING, year INT, value DOUBLE, batch_date STRING,
    ingested_at STRING, source STRING
"""

PRICE_EVENT = """
    coin_id STRING, symbol STRING, name STRING, current_price_usd DOUBLE,
    market_cap_usd DOUBLE, market_cap_rank INT, volume_24h_usd DOUBLE,
    price_change_1h_pct DOUBLE, price_change_24h_pct DOUBLE,
    price_change_7d_pct DOUBLE, ath_usd DOUBLE, ath_change_pct DOUBLE,
    circulating_supply DOUBLE, last_updated STRING, ingested_at STRING, layer STRING
"""

DAILY_CANDLE = """
    coin_id STRING, candle_date STRING, timestamp_ms DOUBLE, open DOUBLE,
    high DOUBLE, low DOUBLE, close DOUBLE, price_range DOUBLE,
    is_bullish BOOLEAN, batch_date STRING, ingested_at STRING
"""

AUDIT_ROW = """
    dag_id STRING, execution_date DATE, records_extracted BIGINT,
    records_staged BIGINT, records_loaded BIGINT, status STRING, logged_at TIMESTAMP
"""

# Raw API payloads.
WEATHER_PAYLOAD = """
    city STRING, daily STRUCT<
        time: ARRAY<STRING>, temperature_2m_max: ARRAY<DOUBLE>,
        temperature_2m_min: ARRAY<DOUBLE>, temperature_2m_mean: ARRAY<DOUBLE>,
        precipitation_sum: ARRAY<DOUBLE>, wind_speed_10m_max: ARRAY<DOUBLE>>
"""

INDICATOR_ITEM = """
    country STRUCT<id: STRING, value: STRING>,
    indicator STRUCT<id: STRING, value: STRING>, date STRING, value DOUBLE
"""

CANDLE_PAYLOAD = "coin_id STRING, candles ARRAY<ARRAY<DOUBLE>>"

REPOSITORY_PAYLOAD = """
    id BIGINT, full_name STRING, description STRING, stargazers_count INT,
    forks_count INT, watchers_count INT, license STRUCT<spdx_id: STRING>,
    topics ARRAY<STRING>, created_at STRING
"""

# The indicator names of the wide panel, in column order.
INDICATORS = [
    "gdp_current_usd",
    "gdp_growth_pct",
    "gdp_per_capita_usd",
    "inflation_cpi_pct",
    "unemployment_rate_pct",
    "population_total",
    "internet_users_pct",
    "co2_emissions_per_capita",
]
