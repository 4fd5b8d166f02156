"""JSON records: decoding with rejects, payload flattening, serialising."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill import schemas
from tidemill.functions.text import excerpt

REJECT = "_corrupt_record"


def decode(log: DataFrame, ddl: str) -> DataFrame:
    """One column per declared field of the JSON text in ``value``.

    Unlisted fields are dropped; malformed text gives a row of NULLs.  The
    record is unfolded by a generator, past which Catalyst pushes no filter on
    its fields: the text is parsed once, not once more for every such filter.
    """
    record = F.from_json(F.col("value").cast("string"), ddl)
    return log.select(F.inline(F.array(record)))


def decode_with_rejects(log: DataFrame, ddl: str) -> DataFrame:
    """Like ``decode`` plus the text of malformed records in ``_corrupt_record``.

    One pass over the log serves both sides: filter on that column for each.
    """
    schema = T.StructType.fromDDL(ddl).add(REJECT, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT}
    record = F.from_json(F.col("value").cast("string"), schema, options)
    return log.select(F.inline(F.array(record)))


def encode(df: DataFrame) -> DataFrame:
    """Each row as JSON text in ``value``; NULL fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def nested_or(json_col: str, path: str, default: str) -> Column:
    """Text at a JSON path, ``default`` where the path is missing or null."""
    return F.coalesce(F.get_json_object(json_col, path), F.lit(default))


def flatten_key(df: DataFrame, key: str) -> DataFrame:
    """The fields of a struct column as top-level columns, in front."""
    return df.select(f"{key}.*", *[c for c in df.columns if c != key])


def weather_rows(log: DataFrame) -> DataFrame:
    """Parallel daily arrays to one row per city and day; short arrays give NULL."""
    daily = decode(log, schemas.WEATHER_PAYLOAD)
    names = {
        "date": "time",
        "temp_max_c": "temperature_2m_max",
        "temp_min_c": "temperature_2m_min",
        "temp_mean_c": "temperature_2m_mean",
        "precipitation_mm": "precipitation_sum",
        "wind_speed_max_kmh": "wind_speed_10m_max",
    }
    # A variable that the response lacks is an empty array, so its values are NULL.
    arrays = [
        F.coalesce(f"daily.{field}", F.array().cast(daily.schema["daily"].dataType[field].dataType)).alias(name)
        for name, field in names.items()
    ]
    zipped = F.arrays_zip(*arrays)
    return daily.select("city", F.inline(zipped)).where(F.col("date").isNotNull())


def candle_rows(log: DataFrame) -> DataFrame:
    """Positional ``[ms, open, high, low, close]`` arrays to candle rows."""
    raw = decode(log, schemas.CANDLE_PAYLOAD).select("coin_id", F.explode("candles").alias("c"))
    part = {name: F.get("c", F.lit(i)) for i, name in enumerate(["ms", "open", "high", "low", "close"])}
    # The UTC day, whatever the session's time zone.
    utc_day = F.date_from_unix_date(F.floor(part["ms"] / F.lit(86_400_000.0)).cast("int"))
    return raw.select(
        "coin_id",
        utc_day.alias("candle_date"),
        part["ms"].alias("timestamp_ms"),
        *[part[name].alias(name) for name in ("open", "high", "low", "close")],
        F.round(part["high"] - part["low"], 6).alias("price_range"),
        (part["close"] >= part["open"]).alias("is_bullish"),
    )


def indicator_rows(log: DataFrame) -> DataFrame:
    """``[meta, [items]]`` responses to long rows; items without value are skipped.

    The two elements have different shapes, so the outer array is read as text
    and only the item list is decoded.
    """
    items = F.get(F.from_json("value", "ARRAY<STRING>"), F.lit(1))
    item_type = f"ARRAY<STRUCT<{schemas.INDICATOR_ITEM.strip()}>>"
    raw = log.select(F.explode(F.from_json(items, item_type)).alias("i"))
    return raw.where(F.col("i.value").isNotNull()).select(
        F.col("i.country.id").alias("country_code"),
        F.col("i.country.value").alias("country_name"),
        F.col("i.indicator.id").alias("indicator_code"),
        F.col("i.indicator.value").alias("indicator_name"),
        F.col("i.date").try_cast("int").alias("year"),
        F.col("i.value").alias("value"),
    )


def repository_rows(log: DataFrame, description_chars: int | None = None) -> DataFrame:
    """Repository API items with nested defaults and joined topics; the description whole, or cut."""
    raw = decode(log, schemas.REPOSITORY_PAYLOAD)
    description = F.coalesce("description", F.lit(""))
    return raw.select(
        F.col("id").alias("repo_id"),
        F.col("full_name").alias("repo_name"),
        (description if description_chars is None else excerpt(description, description_chars)).alias("description"),
        F.col("stargazers_count").alias("stars"),
        F.col("forks_count").alias("forks"),
        F.col("watchers_count").alias("watchers"),
        F.coalesce(F.col("license.spdx_id"), F.lit("NONE")).alias("license"),
        F.concat_ws(",", F.coalesce("topics", F.array().cast("array<string>"))).alias("topics"),
        "created_at",
    )
