"""Shared pieces of the registered queries: tables, derived views, SQL macros.

A view is one SELECT over the given tables that both engines understand.  Spark
runs it over DataFrames, the oracle as a subquery.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# The clock of all queries over events (they span 2024-01-01 to 2024-01-30).
AS_OF = "2024-01-31 00:00:00"
# The clock of the country panel (orders span 1995 to 2001).
PANEL_AS_OF = "2001-12-31 00:00:00"


@dataclass(frozen=True)
class Registered:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@dataclass(frozen=True)
class View:
    """``text`` names its inputs in braces; they are tables or other views."""

    text: str
    tables: tuple[str, ...] = ()
    views: tuple[tuple[str, View], ...] = ()

    def df(self, spark: SparkSession, sf: str) -> DataFrame:
        inputs = {name: table(spark, sf, name) for name in self.tables}
        inputs |= {name: view.df(spark, sf) for name, view in self.views}
        out = spark.sql(self.text, **inputs)
        # The tables hold zone-free times; literals in the text should not differ.
        zoned = {c: out[c].cast("timestamp_ntz") for c, kind in out.dtypes if kind == "timestamp"}
        return out.withColumns(zoned) if zoned else out

    @property
    def sql(self) -> str:
        inputs = {name: name for name in self.tables}
        inputs |= {name: f"({view.sql}) AS {name}" for name, view in self.views}
        return self.text.format(**inputs)


def rounded(x: str, digits: int) -> str:
    """Spark's ``round`` of a double: half up on its shortest decimal text."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def total(c: str, over: str = "") -> str:
    """The sum of doubles, rounded once: the engine's own sums change digits with the order of rows.

    Doubles of the tables are whole multiples of 2^-66, which add up as HUGEINT; both parts of
    the sum are doubles, and adding them is the only rounding.
    """
    whole = f"sum(CAST(CAST({c} AS DOUBLE) * {2.0**66!r} AS HUGEINT)){over}"
    return f"(CAST({whole} // {1 << 50} AS DOUBLE) * {2.0**-16!r} + CAST({whole} % {1 << 50} AS DOUBLE) * {2.0**-66!r})"


def mean(c: str, over: str = "") -> str:
    return f"({total(c, over)} / nullif(count({c}){over}, 0))"


def pct(condition: str, digits: int | None = None) -> str:
    out = f"(CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) / nullif(count(*), 0) * 100)"
    return out if digits is None else rounded(out, digits)


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def change(new: str, old: str) -> str:
    return f"({ratio(f'{new} - {old}', old)} * 100)"


# -- derived views ------------------------------------------------------------

READINGS = View(
    """
    SELECT CAST(user_id AS STRING) AS sensor_id, event_type AS city, ts AS event_time,
           CAST(user_id % 90 AS DOUBLE) AS latitude, CAST(user_id % 180 AS DOUBLE) AS longitude,
           CASE WHEN event_id % 50 = 0 OR event_id % 28 = 3 THEN NULL ELSE value END AS temperature_c,
           CASE WHEN event_id % 33 = 0 THEN NULL ELSE CAST(event_id % 101 AS DOUBLE) END AS humidity_pct,
           CAST(event_id % 40 AS DOUBLE) / 10 AS precipitation_mm,
           CAST(event_id % 173 AS DOUBLE) / 4 AS wind_speed_kmh,
           CAST(event_id % 360 AS DOUBLE) AS wind_direction_deg,
           CAST(event_id % 100 AS INT) AS weather_code,
           CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 3 = 1 END AS synced,
           event_id, CAST(event_id % 4 AS INT) AS batch_id
    FROM {events}
    """,
    ("events",),
)

DAILY = View(
    """
    SELECT event_type AS city, CAST(ts AS DATE) AS day, count(*) AS n,
           max(value) AS hi, min(value) AS lo, max(event_id) AS last_id,
           CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS BIGINT) AS cents
    FROM {events} GROUP BY event_type, CAST(ts AS DATE)
    """,
    ("events",),
)

# Every day is ingested twice; the first copy is wrong.
DAILY_WEATHER = View(
    " UNION ALL ".join(
        f"""
        SELECT city, CAST(day AS STRING) AS date,
               hi + {bad} AS temp_max_c, lo AS temp_min_c, CAST(cents AS DOUBLE) / 100 / n AS temp_mean_c,
               CASE WHEN n % 9 = 0 THEN NULL ELSE CAST(n % 21 AS DOUBLE) / 10 END AS precipitation_mm,
               CAST(n % 17 AS DOUBLE) AS wind_speed_max_kmh, CAST(n % 23 AS DOUBLE) / 2 AS solar_radiation_sum,
               TIMESTAMP '2024-01-30 0{hour}:00:00' AS ingested_at
        FROM {{daily}}
        """
        for bad, hour in ((5, 1), (0, 2))
    ),
    views=(("daily", DAILY),),
)

REPOS = View(
    """
    SELECT p_partkey + 3000000000 AS repo_id, p_name AS repo_name, concat('  ', upper(p_brand), ' ') AS language,
           CAST(p_size - 2 AS INT) AS stars, CAST(p_partkey % 37 AS INT) AS forks,
           CAST(p_partkey % 11 AS INT) AS watchers,
           CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS license,
           CASE WHEN p_partkey % 53 = 0 THEN 'not a date'
                ELSE CAST(CAST('2024-01-31' AS DATE) - CAST(p_partkey % 365 AS INT) AS STRING) END AS created_at,
           CAST(CASE WHEN p_partkey % 5 = 0 THEN DATE '2024-01-30' ELSE DATE '2024-01-31' END AS STRING) AS batch_date,
           TIMESTAMP '2024-01-31 00:00:00' AS ingested_at
    FROM {part}
    """,
    ("part",),
)

CANDLES = View(
    """
    SELECT event_type AS coin_id, CAST(ts AS DATE) AS candle_date,
           min_by(value, ts) AS open, max(value) AS high, min(value) AS low, max_by(value, ts) AS close,
           DATE '2024-01-31' AS batch_date
    FROM {events} GROUP BY event_type, CAST(ts AS DATE)
    """,
    ("events",),
)

PRICES = View(
    """
    SELECT concat('coin', CAST(user_id AS STRING)) AS coin_id, upper(event_type) AS symbol, event_type AS name,
           value AS current_price_usd, value * 1000 + user_id AS market_cap_usd,
           CAST(user_id % 40 + 1 AS INT) AS market_cap_rank, CAST(event_id AS DOUBLE) AS volume_24h_usd,
           CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(event_id % 241 AS DOUBLE) / 10 - 12 END
               AS price_change_24h_pct,
           ts AS event_time, event_id
    FROM {events}
    """,
    ("events",),
)

POSTS = View(
    """
    SELECT CAST(doc_id AS STRING) AS post_id, source AS subreddit, concat('Post ', CAST(doc_id AS STRING)) AS title,
           text AS body, CAST(n_chars % 500 AS INT) AS score, CAST(n_chars % 97 AS INT) AS num_comments,
           CAST(doc_id % 101 AS DOUBLE) / 100 AS upvote_ratio, lang AS flair,
           TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 HOUR * CAST(doc_id % 720 AS INT) AS created_utc,
           TIMESTAMP '2024-01-01 00:30:00' + INTERVAL 1 HOUR * CAST(doc_id % 720 AS INT) AS ingested_at,
           doc_id
    FROM {documents}
    """,
    ("documents",),
)

# Word -> (valence, polarity): frequent words of the documents, so that scores vary.
LEXICON = {
    "the": (1.2, 0.3), "and": (-0.8, -0.2), "that": (0.5, 0.13636363636), "for": (-1.5, -0.4), "with": (2.0, 0.6),
    "is": (-0.90004, -0.35), "le": (0.4, 0.05), "la": (-0.7, -0.15), "les": (1.1, 0.2), "des": (-1.3, -0.5),
    "der": (0.6, 0.25), "und": (-0.4, -0.3), "die": (-0.2, 0.15), "el": (0.3, -0.1), "de": (-0.6, 0.1),
}

_LEXICON_ROWS = ", ".join(
    f"('{w}', CAST('{v}' AS DECIMAL(18,11)), CAST('{p}' AS DECIMAL(18,11)))" for w, (v, p) in LEXICON.items()
)


def scored_sql(posts: str) -> str:
    """Lexicon sentiment of ``posts`` (a subquery) in the oracle's dialect."""
    return f"""
    SELECT p.*, {rounded('first', 4)} AS compound_score, {rounded('second', 4)} AS polarity_score,
           {rounded('(first + second) / 2', 4)} AS sentiment_score,
           CASE WHEN (first + second) / 2 >= CAST(0.05 AS DOUBLE) THEN 'positive'
                WHEN (first + second) / 2 <= CAST(-0.05 AS DOUBLE) THEN 'negative'
                ELSE 'neutral' END AS sentiment_label
    FROM (
        SELECT post_id AS scored_id, s / sqrt(s * s + 15) AS first,
               coalesce(q / nullif(CAST(n AS DOUBLE), 0), 0) AS second
        FROM (
            SELECT post_id, CAST(coalesce(sum(v), 0) AS DOUBLE) AS s,
                   CAST(coalesce(sum(q), 0) AS DOUBLE) AS q, count(v) AS n
            FROM (
                SELECT post_id, unnest(string_split_regex(
                    lower(concat(title, ' ', body)), '[^\\p{{L}}\\p{{N}}'']+')) AS word
                FROM ({posts})) t
            LEFT JOIN (VALUES {_LEXICON_ROWS}) AS l(word, v, q) USING (word)
            GROUP BY post_id)) m
    JOIN ({posts}) p ON p.post_id = m.scored_id
    """


SCORED = f"SELECT * EXCLUDE (scored_id) FROM (SELECT 0 AS scored_id, * FROM ({scored_sql(POSTS.sql)}))"

COUNTRY_YEAR = View(
    """
    SELECT concat('n', CAST(n_nationkey AS STRING)) AS code, n_name AS country, n_nationkey AS k, yr,
           CAST(sum(n) AS BIGINT) AS n, CAST(sum(cents) AS BIGINT) AS cents, CAST(sum(f) AS DOUBLE) AS f,
           CAST(sum(p) AS DOUBLE) AS p, CAST(sum(o) AS DOUBLE) AS o, CAST(sum(u) AS DOUBLE) AS u,
           CAST(sum(h) AS DOUBLE) AS h
    FROM (
        SELECT o_custkey, CAST(extract(YEAR FROM o_orderdate) AS INT) AS yr, count(*) AS n,
               sum(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS cents,
               sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS f,
               sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS p,
               sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS o,
               sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS u,
               sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS h
        FROM {orders} GROUP BY o_custkey, CAST(extract(YEAR FROM o_orderdate) AS INT)) c
    JOIN {customer} ON o_custkey = c_custkey
    JOIN {nation} ON c_nationkey = n_nationkey
    GROUP BY n_nationkey, n_name, yr
    """,
    ("orders", "customer", "nation"),
)

# The wide truth behind the long log.
PANEL_TRUTH = View(
    """
    SELECT code AS country_code, country AS country_name, yr AS year,
           CAST(cents AS DOUBLE) / 100 AS gdp_current_usd,
           u / n * 20 - 2 AS gdp_growth_pct,
           CAST(cents AS DOUBLE) / 100 / n / (CASE k % 4 WHEN 0 THEN 20 WHEN 1 THEN 60 WHEN 2 THEN 240 ELSE 1000 END)
               AS gdp_per_capita_usd,
           CASE WHEN (yr + k) % 11 = 0 THEN NULL ELSE f / n * 10 END AS inflation_cpi_pct,
           p / n * 20 AS unemployment_rate_pct,
           CAST(n * 1000 AS DOUBLE) AS population_total,
           o / n * 180 AS internet_users_pct,
           h / n * 20 AS co2_emissions_per_capita
    FROM {country_year}
    """,
    views=(("country_year", COUNTRY_YEAR),),
)
