"""Daily weather: features and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numeric import flag
from tidemill.functions.sums import mean, total
from tidemill.functions.time import clock, from_date, parse_date, week_of
from tidemill.operators.dedup import latest_per_key
from tidemill.operators.rollups import rollup

# Fixed value: millimetres above which a day is rainy.
RAINY_ABOVE_MM = 1.0


def weather_features(days: DataFrame, as_of) -> DataFrame:
    """Latest row per city and day with temperature range and rain flag."""
    return (
        latest_per_key(days, ["city", "date"], ["ingested_at"])
        .withColumn("date", parse_date("date"))
        .withColumn("temp_range_c", F.round(F.col("temp_max_c") - F.col("temp_min_c"), 2))
        .withColumn("is_rainy", flag(F.col("precipitation_mm") > RAINY_ABOVE_MM))
        .withColumn("batch_date", clock(as_of).cast("date"))
    )


def summary(features: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Totals and extremes per city over the last days."""
    return rollup(
        features.where(from_date("date", as_of, days)),
        ["city"],
        days_recorded=F.count(F.lit(1)),
        avg_temp_c=F.round(mean("temp_mean_c"), 2),
        highest_temp_c=F.round(F.max("temp_max_c"), 2),
        lowest_temp_c=F.round(F.min("temp_min_c"), 2),
        total_rain_mm=F.round(total("precipitation_mm"), 1),
        rainy_days=F.count_if("is_rainy"),
        avg_max_wind_kmh=F.round(mean("wind_speed_max_kmh"), 1),
        avg_solar_mj_m2=F.round(mean("solar_radiation_sum"), 1),
    ).orderBy(F.col("total_rain_mm").desc_nulls_first(), "city")


def weekly_trend(features: DataFrame) -> DataFrame:
    """Per city and week; weeks start on Monday."""
    return rollup(
        features,
        ["city", week_of("date").alias("week_start")],
        avg_temp_c=F.round(mean("temp_mean_c"), 2),
        max_temp_c=F.round(F.max("temp_max_c"), 2),
        weekly_rain_mm=F.round(total("precipitation_mm"), 2),
        rainy_days_in_week=F.count_if("is_rainy"),
    ).orderBy("city", F.col("week_start").desc())
