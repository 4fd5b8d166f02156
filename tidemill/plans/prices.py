"""Market prices: event enrichment, candle indicators, serving views, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.functions.numeric import annualised, band, change_pct, flag, ratio, share_pct
from tidemill.functions.records import decode
from tidemill.functions.sums import correlations, mean, stddev, with_products
from tidemill.functions.time import before, clock, from_date, parse_date, parse_time
from tidemill.operators.dedup import latest_per_key
from tidemill.operators.ranking import global_rank, top
from tidemill.operators.series import crosses_above, first_and_last, moving_average, per_period, return_pct
from tidemill.sources.tables import key_history

# Volatility floors (absolute percent change), size of the top list.
VOLATILITY_FLOORS = [(10, "extreme"), (5, "high"), (2, "medium")]
TOP_RANK = 10


def volatility_class(change_24h: str) -> Column:
    return F.when(F.col(change_24h).isNull(), "unknown").otherwise(
        band(F.abs(change_24h), VOLATILITY_FLOORS, "low")
    )


def decode_prices(log: DataFrame) -> DataFrame:
    return decode(log, schemas.PRICE_EVENT).withColumn("event_time", parse_time("last_updated"))


def enrich_prices(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Volatility class and top-list flag; stateless, for batch and stream."""
    added = {
        "volatility_class": volatility_class("price_change_24h_pct"),
        "is_top10": flag(F.col("market_cap_rank") <= TOP_RANK),
    }
    if processed_at is not None:
        added["processed_at"] = processed_at
    return events.withColumns(added)


def price_events(log: DataFrame) -> DataFrame:
    """Bounded log to enriched events, one per key and update time."""
    return enrich_prices(latest_per_key(decode_prices(log), ["coin_id", "last_updated"], ["ingested_at"]))


def candle_days(log: DataFrame) -> DataFrame:
    """Candles of a log: one per key and day, the latest batch, positive closes."""
    raw = decode(log, schemas.DAILY_CANDLE).withColumn("candle_date", parse_date("candle_date"))
    days = per_period(raw, "coin_id", "candle_date", ["ingested_at", "batch_date"])
    return days.where(F.col("close") > 0)


def technical_indicators(candles: DataFrame, as_of) -> DataFrame:
    """Return, 7- and 30-row averages, high/low ratio and golden cross per day.

    Candles are one row per key and day, so a key's series is bounded by the
    calendar; all columns share one exchange and one sort.
    """
    key, day = "coin_id", "candle_date"
    return (
        candles.withColumns(
            {
                "daily_return_pct": return_pct("close", key, day, 4),
                "ma_7d": F.round(moving_average("close", key, day, 7), 6),
                "ma_30d": F.round(moving_average("close", key, day, 30), 6),
                "high_low_ratio": F.round(ratio("high", "low"), 4),
            }
        )
        .withColumn("golden_cross", crosses_above("ma_7d", "ma_30d", key, day))
        .withColumn("loaded_at", clock(as_of))
    )


def performance_rank(history: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Return over the period per key and its rank.

    The reported query ranks every daily row and removes duplicates afterwards,
    so its ranks skip by the number of days of each better key: that is a rank
    of per-key rows weighted by their day count.  ``return_rank`` has no gaps.
    """
    recent = history.where(from_date("candle_date", as_of, days))
    ends = first_and_last(recent, "coin_id", "candle_date", "close", "price_30d_ago", "price_latest")
    ends = ends.withColumn("gain", ratio(F.col("price_latest") - F.col("price_30d_ago"), "price_30d_ago"))
    ranked = global_rank(ends, "gain", dense="return_rank", rank="perf_rank", weight="rows")
    return ranked.select(
        "coin_id",
        F.round("price_30d_ago", 4).alias("price_30d_ago"),
        F.round("price_latest", 4).alias("price_latest"),
        F.round(F.col("gain") * 100, 2).alias("return_30d_pct"),
        "perf_rank", "return_rank",
    ).orderBy(F.col("return_30d_pct").desc_nulls_last(), "coin_id")


def volatility(history: DataFrame, as_of, days: int = 90, min_days: int = 60) -> DataFrame:
    """Spread of daily returns per key with enough trading days."""
    daily = "daily_return_pct"
    return (
        with_products(history.where(from_date("candle_date", as_of, days)), (daily, daily))
        .groupBy("coin_id")
        .agg(
            F.count(F.lit(1)).alias("trading_days"),
            F.round(mean(daily), 3).alias("avg_daily_return"),
            F.round(stddev(daily), 3).alias("daily_volatility"),
            F.round(F.max(daily), 2).alias("max_single_day_gain"),
            F.round(F.min(daily), 2).alias("max_single_day_loss"),
            F.round(annualised(stddev(daily)), 2).alias("annualized_volatility"),
            F.count_if("is_bullish").alias("bullish_days"),
            share_pct(F.col("is_bullish"), 1).alias("bull_day_pct"),
        )
        .where(F.col("trading_days") >= min_days)
        .orderBy(F.col("annualized_volatility").desc_nulls_last(), "coin_id")
    )


def crossover_signals(history: DataFrame, as_of, days: int = 90) -> DataFrame:
    return history.where(F.col("golden_cross") & from_date("candle_date", as_of, days)).select(
        "coin_id",
        F.col("candle_date").alias("signal_date"),
        F.round("close", 4).alias("price_at_signal"),
        F.round("ma_7d", 4).alias("ma_7d"),
        F.round("ma_30d", 4).alias("ma_30d"),
        change_pct("ma_7d", "ma_30d", 2).alias("ma_spread_pct"),
    ).orderBy(F.col("signal_date").desc(), "coin_id")


def correlation_to(history: DataFrame, reference: str, as_of, days: int = 90, min_points: int = 50) -> DataFrame:
    """Correlation of every key's daily returns with those of one key.

    The reference side is aggregated to one row per day of the window, so it
    has at most ``days`` + 1 rows, which is what allows the broadcast.
    """
    day = F.col("candle_date")
    window = history.where(from_date("candle_date", as_of, days) & (day <= clock(as_of).cast("date")))
    anchor = window.where(F.col("coin_id") == reference).groupBy("candle_date").agg(
        F.max("daily_return_pct").alias("reference_return")
    )
    others = window.where(F.col("coin_id") != reference).select("coin_id", "candle_date", "daily_return_pct")
    paired = others.join(F.broadcast(anchor), "candle_date")
    return (
        correlations(
            paired, ["coin_id"], "reference_return", "daily_return_pct", "btc_correlation", data_points=F.count(F.lit(1))
        )
        .withColumn("btc_correlation", F.round("btc_correlation", 3))
        .where(F.col("data_points") >= min_points)
        .orderBy(F.col("btc_correlation").desc_nulls_last(), "coin_id")
    )


# -- serving ----------------------------------------------------------------

LATEST_FIELDS = [
    "coin_id", "symbol", "name", "current_price_usd", "market_cap_usd", "market_cap_rank",
    "price_change_24h_pct", "volatility_class", "event_time",
]


def latest_view(events: DataFrame) -> DataFrame:
    """The newest event per key."""
    fields = [c for c in LATEST_FIELDS if c in events.columns]
    return latest_per_key(events.select(*fields), ["coin_id"], ["event_time", "current_price_usd"])


def latest_prices(events: DataFrame, k: int = 20) -> DataFrame:
    """The largest keys by market value, with their newest price."""
    return top(latest_view(events), k, F.col("market_cap_usd").desc_nulls_last(), "coin_id")


def extreme_movers(events: DataFrame) -> DataFrame:
    view = latest_view(events).where(F.col("volatility_class") == "extreme")
    return view.select("coin_id", "symbol", "current_price_usd", "price_change_24h_pct")


def price_history(events: DataFrame, coin_id: str, as_of, hours: int = 24, limit: int | None = None) -> DataFrame:
    shown = ["current_price_usd", "volume_24h_usd", "price_change_24h_pct"]
    rows = key_history(events, "coin_id", coin_id, "event_time", before(as_of, f"{hours} HOUR"), limit, shown)
    return rows.select("event_time", "current_price_usd", "volume_24h_usd", "price_change_24h_pct")


def serving_view(history: DataFrame, events: DataFrame) -> DataFrame:
    """Batch and speed layer merged: per key the price with the newer time wins.

    Both sides are reduced to one row per key before the join.  A candle counts
    from the start of its day.
    """
    batch = history.groupBy("coin_id").agg(
        F.max("candle_date").cast("timestamp_ntz").alias("batch_time"),
        F.max_by("close", "candle_date").alias("batch_price"),
    )
    speed = events.groupBy("coin_id").agg(
        F.max("event_time").cast("timestamp_ntz").alias("speed_time"),
        F.max_by("current_price_usd", F.struct("event_time", "current_price_usd")).alias("speed_price"),
    )
    newer = F.col("speed_time").isNotNull() & (
        F.col("batch_time").isNull() | (F.col("speed_time") >= F.col("batch_time"))
    )
    return batch.join(speed, "coin_id", "full_outer").select(
        "coin_id",
        F.when(newer, F.col("speed_price")).otherwise(F.col("batch_price")).alias("price"),
        F.when(newer, F.col("speed_time")).otherwise(F.col("batch_time")).alias("price_time"),
        F.when(newer, F.lit("speed")).otherwise(F.lit("batch")).alias("layer"),
    )
