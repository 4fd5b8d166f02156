"""Registered queries over country indicators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill import schemas
from tidemill.functions.records import encode
from tidemill.operators import quality
from tidemill.operators.ranking import global_rank
from tidemill.operators.series import prior_period
from tidemill.plans import indicators as plan
from tidemill.registered.base import (
    PANEL_AS_OF, PANEL_TRUTH, Registered, change, mean, rounded, table,
)
from tidemill.schemas import INDICATORS
from tidemill.session import new_folder
from tidemill.sinks.models import Model, publish_models
from tidemill.sources.logs import Log, read_log
from tidemill.functions.records import decode

QUERIES: dict[str, Registered] = {}
NOW = f"TIMESTAMP '{PANEL_AS_OF}'"


def _add(name, run, sql=None):
    QUERIES[name] = Registered(run, sql)


def _sent(spark, sf):
    """The panel as long records, each sent twice; the first copy is wrong."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in INDICATORS)
    long = PANEL_TRUTH.df(spark, sf).select(
        "country_code", "country_name", "year",
        F.expr(f"stack({len(INDICATORS)}, {pairs}) AS (indicator_name, value)"),
    )
    return long.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).select(
        "country_code", "country_name", "indicator_name", "year",
        F.when(F.col("copy") == 1, F.col("value") / 2).otherwise(F.col("value")).alias("value"),
        F.lit("2001-12-31").alias("batch_date"),
        F.concat(F.lit("2001-12-31T0"), "copy", F.lit(":00:00")).alias("ingested_at"),
        F.lit("api").alias("source"),
    )


def _panel_of_log(spark, sf):
    """The panel from a log of JSON records."""
    path = new_folder(spark, "indicator-log")
    encode(_sent(spark, sf)).write.text(path)
    return plan.panel(
        decode(read_log(spark, Log(path, "text")), schemas.COUNTRY_INDICATOR), PANEL_AS_OF, "2001-12-31"
    )


def _panel(spark, sf):
    """The panel from the records as they are."""
    fields = T.StructType.fromDDL(schemas.COUNTRY_INDICATOR).fields
    sent = _sent(spark, sf)
    value = {c: F.col(c) for c in sent.columns}
    records = sent.select(*[value.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    return plan.panel(records, PANEL_AS_OF, "2001-12-31")


def _staging(spark, sf):
    return plan.staging(_panel(spark, sf), PANEL_AS_OF)


_INCOME = """CASE WHEN gdp_per_capita_usd >= 12696 THEN 'High income'
    WHEN gdp_per_capita_usd >= 4096 THEN 'Upper-middle income'
    WHEN gdp_per_capita_usd >= 1046 THEN 'Lower-middle income' ELSE 'Low income' END"""
_LAG = "lag(gdp_current_usd) OVER (PARTITION BY country_code ORDER BY year)"
_PANEL_SQL = f"""
    SELECT *, {rounded(change('gdp_current_usd', _LAG), 2)} AS gdp_yoy_growth_calc, {_INCOME} AS income_group,
           coalesce(internet_users_pct >= 60, FALSE) AS is_digital_ready, DATE '2001-12-31' AS batch_date,
           {NOW} AS loaded_at
    FROM ({PANEL_TRUTH.sql}) t WHERE year BETWEEN 1990 AND 2001
"""
_STAGING_SQL = f"""
    SELECT upper(trim(country_code)) AS country_code,
           upper(substr(country_name, 1, 1)) || lower(substr(country_name, 2)) AS country_name, year,
           gdp_current_usd AS gdp_usd, gdp_growth_pct, gdp_per_capita_usd, inflation_cpi_pct AS inflation_pct,
           unemployment_rate_pct AS unemployment_pct, CAST(population_total AS BIGINT) AS population,
           internet_users_pct, co2_emissions_per_capita AS co2_per_capita, income_group, is_digital_ready,
           batch_date, loaded_at
    FROM ({_PANEL_SQL})
"""


def _mart_sql(where: str) -> str:
    health = (
        "coalesce(s.gdp_growth_pct, 0) * CAST(0.4 AS DOUBLE) + coalesce(s.inflation_pct, 0) * CAST(-0.3 AS DOUBLE)"
        " + coalesce(s.unemployment_pct, 0) * CAST(-0.3 AS DOUBLE)"
    )
    return f"""
    SELECT s.country_code, s.country_name, s.year, {rounded('s.gdp_usd / 1e9', 2)} AS gdp_billion_usd,
           {rounded('s.gdp_growth_pct', 2)} AS gdp_growth_pct,
           {rounded('s.gdp_per_capita_usd', 0)} AS gdp_per_capita_usd,
           {rounded('s.inflation_pct', 2)} AS inflation_pct, {rounded('s.unemployment_pct', 2)} AS unemployment_pct,
           s.population, {rounded('s.internet_users_pct', 1)} AS internet_users_pct,
           {rounded('s.co2_per_capita', 2)} AS co2_per_capita, s.income_group, s.is_digital_ready,
           {rounded(change('s.gdp_usd', 'p.gdp_usd'), 2)} AS gdp_yoy_change_pct,
           {rounded(health, 2)} AS economic_health_score, {NOW} AS dbt_updated_at
    FROM ({_STAGING_SQL}) s LEFT JOIN ({_STAGING_SQL}) p
      ON s.country_code = p.country_code AND p.year = s.year - 1
    WHERE {where}
    """


_MART = _mart_sql("s.year = 2000")
_MART_ALL = _mart_sql("TRUE")


def _mart(spark, sf, all_years=False):
    return plan.economy_mart(_staging(spark, sf), PANEL_AS_OF, all_years)


_add("indicator_panel", _panel_of_log, _PANEL_SQL)
_add("indicator_staging", _staging, _STAGING_SQL)
_add("economy_mart", _mart, _MART)
_add("economy_mart_all_years", lambda spark, sf: _mart(spark, sf, all_years=True), _MART_ALL)


def _layered(spark, sf):
    """Report, mart and staging in no order: the report reads the mart by SQL, the mart the staging view."""
    folder = new_folder(spark, "layers")
    suffix = folder.rsplit("-", 1)[1]
    stg, mart, report = f"stg_indicators_{suffix}", f"mart_economy_{suffix}", f"report_{suffix}"
    models = [
        Model(report, f"SELECT * FROM {mart}"),
        Model(mart, lambda s: plan.economy_mart(s.table(stg), PANEL_AS_OF), "table", reads=[stg]),
        Model(stg, lambda s: _staging(s, sf)),
    ]
    publish_models(spark, models, folder)
    return spark.table(report)


_add("economy_mart_layered", _layered, _MART)
_add(
    "top_growth_economies",
    lambda spark, sf: plan.top_growth(_mart(spark, sf, all_years=True)),
    f"""
    SELECT country_code, country_name, year, {rounded('m.gdp_growth_pct', 2)} AS gdp_growth_pct,
           {rounded('m.gdp_billion_usd', 1)} AS gdp_billion_usd, income_group
    FROM ({_MART_ALL}) m WHERE m.gdp_growth_pct IS NOT NULL
    ORDER BY m.gdp_growth_pct DESC, country_code, year LIMIT 10
    """,
)
_add(
    "economic_scorecard",
    lambda spark, sf: plan.scorecard(_mart(spark, sf)),
    f"""
    SELECT country_name, income_group, gdp_growth_pct, inflation_pct, unemployment_pct,
           economic_health_score AS health_score, internet_users_pct AS internet_pct, is_digital_ready,
           dense_rank() OVER (ORDER BY economic_health_score DESC NULLS LAST) AS health_rank
    FROM ({_MART})
    """,
)
_add(
    "gdp_trend_of_countries",
    lambda spark, sf: plan.gdp_trend(_staging(spark, sf), ["N1", "N4", "N9", "N16", "N23"]),
    f"""
    SELECT country_name, year, {rounded('gdp_usd / 1e9', 2)} AS gdp_billion_usd,
           {rounded('s.gdp_growth_pct', 2)} AS gdp_growth_pct,
           {rounded('gdp_per_capita_usd', 0)} AS gdp_per_capita, income_group
    FROM ({_STAGING_SQL}) s WHERE country_code IN ('N1', 'N4', 'N9', 'N16', 'N23') AND year >= 2000
    """,
)
_CORR = """covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0)"""
_add(
    "inflation_unemployment_correlation",
    lambda spark, sf: plan.phillips(_staging(spark, sf), first_year=1995, min_years=2),
    f"""
    SELECT country_name, income_group, {rounded(mean('x'), 2)} AS avg_inflation,
           {rounded(mean('y'), 2)} AS avg_unemployment, {rounded(_CORR, 3)} AS phillips_correlation,
           count(*) AS years_of_data
    FROM (SELECT *, inflation_pct AS x, unemployment_pct AS y FROM ({_STAGING_SQL}))
    WHERE year >= 1995 AND x BETWEEN -5 AND 50 AND y BETWEEN 0 AND 30
    GROUP BY country_name, income_group HAVING count(*) >= 2
    """,
)
_add(
    "development_profile",
    lambda spark, sf: plan.development_profile(_mart(spark, sf, all_years=True)),
    f"""
    SELECT country_name, year, internet_users_pct AS internet_pct, co2_per_capita,
           gdp_per_capita_usd AS gdp_per_capita, income_group,
           CASE WHEN internet_users_pct >= 80 AND co2_per_capita <= 5 THEN 'Green Digital'
                WHEN internet_users_pct >= 80 AND co2_per_capita > 5 THEN 'High Carbon Digital'
                WHEN internet_users_pct < 50 AND co2_per_capita <= 3 THEN 'Low Impact Developing'
                ELSE 'Developing' END AS development_profile
    FROM ({_MART_ALL})
    """,
)
_add(
    "gdp_of_calendar_prior_year",
    lambda spark, sf: _staging(spark, sf).select(
        "country_code", "year", "gdp_usd", prior_period("gdp_usd", "country_code", "year").alias("gdp_before")
    ),
    f"""
    SELECT s.country_code, s.year, s.gdp_usd, p.gdp_usd AS gdp_before
    FROM ({_STAGING_SQL}) s LEFT JOIN ({_STAGING_SQL}) p ON s.country_code = p.country_code AND p.year = s.year - 1
    """,
)


def _inventory(spark, sf):
    orders, events = table(spark, sf, "orders"), table(spark, sf, "events")
    return quality.layer_inventory(
        [("STAGING", "orders", orders, "o_orderdate"), ("MARTS", "events", events, "ts")]
    )


_add(
    "layer_inventory",
    _inventory,
    """
    SELECT 'STAGING' AS table_schema, 'orders' AS table_name, count(*) AS row_count, max(o_orderdate) AS last_altered
    FROM orders UNION ALL SELECT 'MARTS', 'events', count(*), max(ts) FROM events
    """,
)
_add(
    "customers_ranked_by_balance",
    lambda spark, sf: global_rank(
        table(spark, sf, "customer").select("c_custkey", F.floor(F.col("c_acctbal") / 10).alias("tens")),
        "tens", dense="dense_no", rank="rank_no",
    ),
    """
    SELECT c_custkey, CAST(floor(c_acctbal / 10) AS BIGINT) AS tens,
           dense_rank() OVER (ORDER BY floor(c_acctbal / 10) DESC) AS dense_no,
           rank() OVER (ORDER BY floor(c_acctbal / 10) DESC) AS rank_no
    FROM customer
    """,
)
