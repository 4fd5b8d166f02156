"""Country indicators: long-to-wide panel, staging model, marts and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numeric import band, change_pct, flag, weighted
from tidemill.functions.sums import correlations, mean
from tidemill.functions.time import clock
from tidemill.operators.dedup import latest_per_key
from tidemill.operators.ranking import global_rank, top
from tidemill.operators.series import prior_period, return_pct
from tidemill.schemas import INDICATORS
from tidemill.sources.tables import among

# Income floors (per-capita USD), digital readiness, score weights, panel start.
INCOME_FLOORS = [(12696, "High income"), (4096, "Upper-middle income"), (1046, "Lower-middle income")]
LOWEST_INCOME = "Low income"
DIGITAL_READY_PCT = 60
HEALTH = [("gdp_growth_pct", 0.4), ("inflation_pct", -0.3), ("unemployment_pct", -0.3)]
FIRST_YEAR = 1990

# Staging names of the raw indicator columns.
STAGING_NAMES = {
    "gdp_current_usd": "gdp_usd",
    "gdp_growth_pct": "gdp_growth_pct",
    "gdp_per_capita_usd": "gdp_per_capita_usd",
    "inflation_cpi_pct": "inflation_pct",
    "unemployment_rate_pct": "unemployment_pct",
    "population_total": "population",
    "internet_users_pct": "internet_users_pct",
    "co2_emissions_per_capita": "co2_per_capita",
}


def widen(long: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """One row per country and year, one column per indicator.

    Of repeated (country, indicator, year) records the latest ingested wins.
    The duplicates collapse map-side, so the later exchanges carry one row per
    panel cell whatever the size of the log.  The value list is given: Spark
    does not have to look for it.
    """
    order = [c for c in ("ingested_at", "batch_date", "value") if c in long.columns]
    cells = latest_per_key(long, ["country_code", "indicator_name", "year"], order)
    cells = cells.where(F.col("value").isNotNull())
    if first_year is not None:
        cells = cells.where(F.col("year").between(first_year, last_year))
    return (
        cells.groupBy("country_code", "country_name", "year")
        .pivot("indicator_name", INDICATORS)
        .agg(F.first("value"))
    )


def panel(long: DataFrame, as_of, batch_date) -> DataFrame:
    """The staging panel: wide rows with computed growth, income group, lineage.

    Growth compares with the country's previous row, across gaps too.
    """
    growth = return_pct("gdp_current_usd", "country_code", "year", 2)
    return (
        widen(long, FIRST_YEAR, clock_year(as_of))
        .withColumn("gdp_yoy_growth_calc", growth)
        .withColumn("income_group", band("gdp_per_capita_usd", INCOME_FLOORS, LOWEST_INCOME))
        .withColumn("is_digital_ready", flag(F.col("internet_users_pct") >= DIGITAL_READY_PCT))
        .withColumn("batch_date", F.lit(batch_date).cast("date"))
        .withColumn("loaded_at", clock(as_of))
    )


def clock_year(as_of) -> int:
    return as_of.year if hasattr(as_of, "year") else int(str(as_of)[:4])


def staging(raw: DataFrame, as_of) -> DataFrame:
    """Standardised names, safe casts, valid years (the staging view)."""
    kind = {"population_total": "bigint"}
    return raw.where(
        F.col("country_code").isNotNull() & F.col("year").between(FIRST_YEAR, clock_year(as_of))
    ).select(
        F.upper(F.trim("country_code")).alias("country_code"),
        F.initcap(F.trim("country_name")).alias("country_name"),
        F.col("year").cast("int").alias("year"),
        *[F.col(c).try_cast(kind.get(c, "double")).alias(name) for c, name in STAGING_NAMES.items()],
        "income_group",
        "is_digital_ready",
        F.col("batch_date").cast("date").alias("batch_date"),
        "loaded_at",
    )


def economy_mart(stg: DataFrame, as_of, all_years: bool = False) -> DataFrame:
    """Rounded indicators, change against the prior year, composite score.

    By default the most recent complete year.  The panel holds a country's year once,
    so the year before is the row before, if that is the year: one pass, no join.
    """
    year = clock_year(as_of)
    rows = stg if all_years else stg.where(F.col("year").isin(year - 2, year - 1))
    rows = rows.withColumn("gdp_before", prior_period("gdp_usd", "country_code", "year"))
    return (rows if all_years else rows.where(F.col("year") == year - 1)).select(
        "country_code",
        "country_name",
        "year",
        F.round(F.col("gdp_usd") / F.lit(1e9), 2).alias("gdp_billion_usd"),
        F.round("gdp_growth_pct", 2).alias("gdp_growth_pct"),
        F.round("gdp_per_capita_usd", 0).alias("gdp_per_capita_usd"),
        F.round("inflation_pct", 2).alias("inflation_pct"),
        F.round("unemployment_pct", 2).alias("unemployment_pct"),
        "population",
        F.round("internet_users_pct", 1).alias("internet_users_pct"),
        F.round("co2_per_capita", 2).alias("co2_per_capita"),
        "income_group",
        "is_digital_ready",
        change_pct("gdp_usd", "gdp_before", 2).alias("gdp_yoy_change_pct"),
        F.round(weighted(HEALTH, missing=0.0), 2).alias("economic_health_score"),
        clock(as_of).alias("dbt_updated_at"),
    )


def top_growth(mart: DataFrame, k: int = 10) -> DataFrame:
    growing = mart.where(F.col("gdp_growth_pct").isNotNull())
    return top(growing, k, F.col("gdp_growth_pct").desc(), "country_code", "year").select(
        "country_code", "country_name", "year",
        F.round("gdp_growth_pct", 2).alias("gdp_growth_pct"),
        F.round("gdp_billion_usd", 1).alias("gdp_billion_usd"), "income_group",
    )


def scorecard(mart: DataFrame) -> DataFrame:
    """Economies with their dense rank by health score."""
    ranked = global_rank(mart, "economic_health_score", dense="health_rank")
    return ranked.select(
        "country_name", "income_group",
        F.round("gdp_growth_pct", 2).alias("gdp_growth_pct"),
        F.round("inflation_pct", 2).alias("inflation_pct"),
        F.round("unemployment_pct", 2).alias("unemployment_pct"),
        F.round("economic_health_score", 2).alias("health_score"),
        F.round("internet_users_pct", 1).alias("internet_pct"),
        "is_digital_ready", "health_rank",
    ).orderBy(F.col("health_score").desc_nulls_last(), "country_name")


def gdp_trend(stg: DataFrame, countries: Sequence[str] | DataFrame, first_year: int = 2000) -> DataFrame:
    chosen = among(stg.where(F.col("year") >= first_year), "country_code", countries)
    return chosen.select(
        "country_name", "year",
        F.round(F.col("gdp_usd") / F.lit(1e9), 2).alias("gdp_billion_usd"),
        F.round("gdp_growth_pct", 2).alias("gdp_growth_pct"),
        F.round("gdp_per_capita_usd", 0).alias("gdp_per_capita"), "income_group",
    ).orderBy("country_name", "year")


def phillips(stg: DataFrame, first_year: int = 2000, min_years: int = 10) -> DataFrame:
    """Inflation against unemployment per country, with enough plausible years."""
    plausible = stg.where(
        (F.col("year") >= first_year)
        & F.col("inflation_pct").between(-5, 50)
        & F.col("unemployment_pct").between(0, 30)
    )
    return (
        correlations(
            plausible, ["country_name", "income_group"], "inflation_pct", "unemployment_pct", "phillips_correlation",
            avg_inflation=F.round(mean("inflation_pct"), 2),
            avg_unemployment=F.round(mean("unemployment_pct"), 2),
            years_of_data=F.count(F.lit(1)),
        )
        .withColumn("phillips_correlation", F.round("phillips_correlation", 3))
        .where(F.col("years_of_data") >= min_years)
        .orderBy(F.abs("phillips_correlation").desc_nulls_last(), "country_name", "income_group")
    )


def development_profile(mart: DataFrame) -> DataFrame:
    online, co2 = F.col("internet_users_pct"), F.col("co2_per_capita")
    # Profile bounds and names.
    profile = (
        F.when((online >= 80) & (co2 <= 5), "Green Digital")
        .when((online >= 80) & (co2 > 5), "High Carbon Digital")
        .when((online < 50) & (co2 <= 3), "Low Impact Developing")
        .otherwise("Developing")
    )
    return mart.select(
        "country_name", "year",
        F.round("internet_users_pct", 1).alias("internet_pct"),
        F.round("co2_per_capita", 2).alias("co2_per_capita"),
        F.round("gdp_per_capita_usd", 0).alias("gdp_per_capita"),
        "income_group", profile.alias("development_profile"),
    ).orderBy(F.col("internet_pct").desc_nulls_first(), "country_name", "year")
