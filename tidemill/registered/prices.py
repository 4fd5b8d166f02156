"""Registered queries over market prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.records import encode
from tidemill.operators import quality
from tidemill.plans import prices as plan
from tidemill.registered.base import (
    AS_OF, CANDLES, PRICES, Registered, change, mean, pct, ratio, rounded,
)
from tidemill.session import new_folder
from tidemill.sources.logs import Log, read_log

QUERIES: dict[str, Registered] = {}
NOW = f"TIMESTAMP '{AS_OF}'"
TODAY = "DATE '2024-01-31'"


def _add(name, run, sql=None):
    QUERIES[name] = Registered(run, sql)


def _history(spark, sf):
    return plan.technical_indicators(CANDLES.df(spark, sf), AS_OF).withColumn(
        "is_bullish", F.col("close") >= F.col("open")
    )


def _ma(rows: int) -> str:
    w = f"(PARTITION BY coin_id ORDER BY candle_date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return rounded(mean("close", f" OVER {w}"), 6)


_PREV = "lag({}) OVER (PARTITION BY coin_id ORDER BY candle_date)"
_HISTORY_SQL = f"""
    SELECT *, coalesce(ma_7d > ma_30d AND {_PREV.format('ma_7d')} <= {_PREV.format('ma_30d')}, FALSE) AS golden_cross,
           {NOW} AS loaded_at, close >= open AS is_bullish
    FROM (
        SELECT *, {rounded(change('close', _PREV.format('close')), 4)} AS daily_return_pct,
               {_ma(7)} AS ma_7d, {_ma(30)} AS ma_30d, {rounded(ratio('high', 'low'), 4)} AS high_low_ratio
        FROM ({CANDLES.sql}))
"""
HISTORY = f"({_HISTORY_SQL}) h"

_add("candle_indicators", _history, _HISTORY_SQL)


def _candle_log(spark, sf):
    """Candles through the log: each sent by two batches, the later one right, some closes not positive."""
    candles = CANDLES.df(spark, sf)
    sent = candles.select(
        "coin_id", F.col("candle_date").cast("string").alias("candle_date"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"),
        "open", "high", "low", F.when(F.col("low") < 0.2, F.lit(0.0)).otherwise(F.col("close")).alias("close"),
        F.lit("2024-01-31").alias("batch_date"),
    )
    sent = sent.withColumn("close", F.when(F.col("copy") == 1, F.lit(1.0)).otherwise(F.col("close")))
    sent = sent.withColumn("ingested_at", F.concat(F.lit("2024-01-31T0"), "copy", F.lit(":00:00"))).drop("copy")
    path = new_folder(spark, "candle-log")
    encode(sent).write.text(path)
    return read_log(spark, Log(path, "text"))


_add(
    "candle_days_from_log",
    lambda spark, sf: plan.candle_days(_candle_log(spark, sf)).select(
        "coin_id", "candle_date", "open", "high", "low", "close"
    ),
    f"SELECT coin_id, candle_date, open, high, low, close FROM ({CANDLES.sql}) WHERE low >= 0.2 AND close > 0",
)
_add(
    "performance_rank_30d",
    lambda spark, sf: plan.performance_rank(_history(spark, sf), AS_OF),
    f"""
    WITH perf AS (
        SELECT coin_id,
               first_value(close) OVER (PARTITION BY coin_id ORDER BY candle_date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS a,
               last_value(close) OVER (PARTITION BY coin_id ORDER BY candle_date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS b
        FROM {HISTORY} WHERE candle_date >= {TODAY} - 30)
    SELECT DISTINCT coin_id, {rounded('a', 4)} AS price_30d_ago, {rounded('b', 4)} AS price_latest,
           {rounded(ratio('b - a', 'a') + ' * 100', 2)} AS return_30d_pct,
           rank() OVER (ORDER BY {ratio('b - a', 'a')} DESC NULLS LAST) AS perf_rank,
           dense_rank() OVER (ORDER BY {ratio('b - a', 'a')} DESC NULLS LAST) AS return_rank
    FROM perf
    """,
)
_SD = "stddev_samp(daily_return_pct)"
_add(
    "volatility_analysis",
    lambda spark, sf: plan.volatility(_history(spark, sf), AS_OF, min_days=20),
    f"""
    SELECT coin_id, count(*) AS trading_days, {rounded(mean('daily_return_pct'), 3)} AS avg_daily_return,
           {rounded(_SD, 3)} AS daily_volatility, {rounded('max(daily_return_pct)', 2)} AS max_single_day_gain,
           {rounded('min(daily_return_pct)', 2)} AS max_single_day_loss,
           {rounded(_SD + ' * sqrt(365)', 2)} AS annualized_volatility,
           count(*) FILTER (WHERE is_bullish) AS bullish_days, {pct('is_bullish', 1)} AS bull_day_pct
    FROM {HISTORY} WHERE candle_date >= {TODAY} - 90 GROUP BY coin_id HAVING count(*) >= 20
    """,
)
_add(
    "crossover_signals",
    lambda spark, sf: plan.crossover_signals(_history(spark, sf), AS_OF),
    f"""
    SELECT coin_id, candle_date AS signal_date, {rounded('close', 4)} AS price_at_signal,
           {rounded('h.ma_7d', 4)} AS ma_7d, {rounded('h.ma_30d', 4)} AS ma_30d,
           {rounded(change('h.ma_7d', 'h.ma_30d'), 2)} AS ma_spread_pct
    FROM {HISTORY} WHERE golden_cross AND candle_date >= {TODAY} - 90
    """,
)
_add(
    "correlation_to_reference_asset",
    lambda spark, sf: plan.correlation_to(_history(spark, sf), "click", AS_OF, min_points=20),
    f"""
    SELECT o.coin_id, {rounded('corr(b.daily_return_pct, o.daily_return_pct)', 3)} AS btc_correlation,
           count(*) AS data_points
    FROM {HISTORY[:-2]} o JOIN {HISTORY[:-2]} b ON o.candle_date = b.candle_date
    WHERE o.coin_id <> 'click' AND b.coin_id = 'click' AND o.candle_date >= {TODAY} - 90
    GROUP BY o.coin_id HAVING count(*) >= 20
    """,
)

# -- speed layer ------------------------------------------------------------------------

_VOLATILITY = """CASE WHEN price_change_24h_pct IS NULL THEN 'unknown'
    WHEN abs(price_change_24h_pct) >= 10 THEN 'extreme' WHEN abs(price_change_24h_pct) >= 5 THEN 'high'
    WHEN abs(price_change_24h_pct) >= 2 THEN 'medium' ELSE 'low' END"""
EVENTS_SQL = f"""
    SELECT *, {_VOLATILITY} AS volatility_class, coalesce(market_cap_rank <= 10, FALSE) AS is_top10
    FROM ({PRICES.sql})
"""


def _events(spark, sf):
    return plan.enrich_prices(PRICES.df(spark, sf))


_add("price_events_enriched", _events, EVENTS_SQL)


def price_log(spark, sf, files: int | None = None):
    """Price events as a log of JSON text; every third event is sent twice."""
    rows = PRICES.df(spark, sf)
    copies = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    sent = rows.select(
        "*", F.explode(copies).alias("copy"), F.col("event_time").cast("string").alias("last_updated")
    ).drop("event_time", "event_id", "copy")
    log = encode(sent)
    path = new_folder(spark, "price-log")
    (log.repartition(files) if files else log).write.text(path)
    return Log(path, "text", intake=None)


_PRICE_FIELDS = [
    "coin_id", "symbol", "name", "current_price_usd", "market_cap_usd", "market_cap_rank", "volume_24h_usd",
    "price_change_24h_pct", "event_time", "volatility_class", "is_top10",
]
_add(
    "price_events_from_log",
    lambda spark, sf: plan.price_events(read_log(spark, price_log(spark, sf)))
    .withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    .select(*_PRICE_FIELDS),
    f"SELECT {', '.join(_PRICE_FIELDS)} FROM ({EVENTS_SQL})",
)

LATEST_SQL = f"""
    SELECT coin_id, symbol, name, current_price_usd, market_cap_usd, market_cap_rank, price_change_24h_pct,
           volatility_class, event_time
    FROM ({EVENTS_SQL})
    QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY event_time DESC, current_price_usd DESC) = 1
"""
_add(
    "latest_prices",
    lambda spark, sf: plan.latest_prices(_events(spark, sf)),
    f"SELECT * FROM ({LATEST_SQL}) ORDER BY market_cap_usd DESC NULLS LAST, coin_id LIMIT 20",
)
_add("latest_price_view", lambda spark, sf: plan.latest_view(_events(spark, sf)), LATEST_SQL)
_add(
    "extreme_movers",
    lambda spark, sf: plan.extreme_movers(_events(spark, sf)),
    f"""
    SELECT coin_id, symbol, current_price_usd, price_change_24h_pct FROM ({LATEST_SQL})
    WHERE volatility_class = 'extreme'
    """,
)
_add(
    "price_history_of_key",
    lambda spark, sf: plan.price_history(_events(spark, sf), "coin17", AS_OF, hours=24 * 14),
    f"""
    SELECT event_time, current_price_usd, volume_24h_usd, price_change_24h_pct FROM ({EVENTS_SQL})
    WHERE coin_id = 'coin17' AND event_time >= {NOW} - INTERVAL 14 DAY
    """,
)


def _merged_layers(spark, sf):
    """All candles merged with all events; the events of some names lie in the past by a month."""
    late = F.when(F.col("name").isin("click", "purchase"), F.col("event_time") - F.expr("INTERVAL 30 DAY"))
    events = _events(spark, sf).withColumn("event_time", F.coalesce(late, "event_time"))
    events = events.withColumn("coin_id", F.when(F.col("name") != "view", F.col("name")).otherwise(F.lit("speed only")))
    return plan.serving_view(CANDLES.df(spark, sf), events)


_add(
    "serving_view_of_both_layers",
    _merged_layers,
    f"""
    WITH b AS (
        SELECT coin_id, max(candle_date)::TIMESTAMP AS t, arg_max(close, candle_date) AS v
        FROM ({CANDLES.sql}) GROUP BY coin_id),
    e AS (
        SELECT name, current_price_usd, CASE WHEN name IN ('click', 'purchase') THEN event_time - INTERVAL 30 DAY
               ELSE event_time END AS event_time
        FROM ({PRICES.sql})),
    s AS (
        SELECT CASE WHEN name <> 'view' THEN name ELSE 'speed only' END AS coin_id, max(event_time) AS t,
               arg_max(current_price_usd, struct_pack(event_time, current_price_usd)) AS v
        FROM e GROUP BY ALL)
    SELECT coalesce(b.coin_id, s.coin_id) AS coin_id,
           CASE WHEN s.t IS NOT NULL AND (b.t IS NULL OR s.t >= b.t) THEN s.v ELSE b.v END AS price,
           CASE WHEN s.t IS NOT NULL AND (b.t IS NULL OR s.t >= b.t) THEN s.t ELSE b.t END AS price_time,
           CASE WHEN s.t IS NOT NULL AND (b.t IS NULL OR s.t >= b.t) THEN 'speed' ELSE 'batch' END AS layer
    FROM b FULL JOIN s ON b.coin_id = s.coin_id
    """,
)
_add(
    "health_of_both_layers",
    lambda spark, sf: quality.layer_health(_events(spark, sf), _history(spark, sf), AS_OF),
    f"""
    SELECT 'speed layer (latest 1h)' AS layer, CAST(count(*) AS INT) AS record_count, CAST(NULL AS VARCHAR) AS note
    FROM ({EVENTS_SQL}) WHERE event_time >= {NOW} - INTERVAL 1 HOUR
    UNION ALL
    SELECT 'batch layer (today)', CAST(count(*) AS INT), max(CAST(loaded_at AS VARCHAR))
    FROM {HISTORY} WHERE batch_date = {TODAY}
    """,
)
