"""The plans that the scale of the data asks for."""

import datetime as dt
import re

from pyspark.sql import functions as F

from __spark_entry__ import queries
from tidemill.functions.records import encode
from tidemill.functions.text import with_sentiment
from tidemill.operators.merge import upsert
from tidemill.plans import posts, prices, readings
from tidemill.registered.base import AS_OF, LEXICON, POSTS, READINGS
from tidemill.sinks.tables import replace_slice
from tidemill.sources.tables import increment, key_history, slice_of
from tidemill.streaming.jobs import windowed_readings


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def scans(df):
    """(pushed filters, columns read) of each file scan; Spark cuts long lists."""
    return re.findall(r"PushedFilters: (\[.*?), ReadSchema: struct<([^>\n]*)", physical(df))


def test_time_filter_and_columns_reach_the_scan(spark, sf):
    ((filters, schema),) = scans(readings.hourly_trend(READINGS.df(spark, sf), AS_OF))
    assert "GreaterThanOrEqual(ts,2024-01-29T00:00)" in filters
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "ts", "event_type", "value"}


def test_key_and_time_reach_the_scan(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    history = key_history(events, "event_type", "click", "ts", F.lit("2024-01-20").cast("timestamp_ntz"), 5)
    ((filters, _),) = scans(history)
    assert "EqualTo(event_type,click)" in filters and "GreaterThanOrEqual(ts" in filters
    assert "TakeOrderedAndProject" in physical(history)
    ((filters, _),) = scans(increment(events, "ts", "event_id", after=("2024-01-20 00:00:00", 5)))
    assert "GreaterThanOrEqual(ts" in filters


def test_slices_are_pruned(spark, sf, tmp_path):
    path = str(tmp_path / "t")
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("day", F.to_date("ts"))
    replace_slice(events, path, ["day"])
    one = slice_of(spark.read.parquet(path), "day", dt.date(2024, 1, 3))
    plan = physical(one)
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan) and "PushedFilters: []" in plan
    assert one.count() == events.where("day = DATE '2024-01-03'").count()


def test_a_filtered_record_is_parsed_once(spark, sf, tmp_path):
    encode(spark.read.parquet(f"{sf}/events.parquet").select("event_id")).write.text(str(tmp_path / "log"))
    plan = optimized(readings.decode_readings(spark.read.text(str(tmp_path / "log"))).where("city = 'x'"))
    assert plan.count("from_json") == 1


def test_a_filtered_text_is_scored_once(spark, sf):
    scored = with_sentiment(POSTS.df(spark, sf), LEXICON)
    plan = optimized(posts.top_positive(scored, "2024-01-15 00:00:00"))
    assert plan.count("split(") == 1
    # The time filter does not wait for the scores.
    assert plan.index("Generate") < plan.rindex("Filter")


def test_reference_series_is_broadcast_after_aggregation(spark, sf):
    plan = physical(queries()["correlation_to_reference_asset"](spark, sf))
    assert "BroadcastHashJoin" in plan


def test_indicators_share_one_exchange_and_sort(spark):
    candles = spark.createDataFrame(
        [("x", dt.date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0)],
        "coin_id STRING, candle_date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE",
    )
    plan = physical(prices.technical_indicators(candles, AS_OF))
    assert plan.count("Exchange") == 1 and len(re.findall(r"\bSort \[", plan)) == 1


def test_updates_are_reduced_before_the_join(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    plan = physical(upsert(orders, orders, ["o_orderkey"], ["o_orderdate"], null_overwrites=True))
    assert "WindowGroupLimit" in plan and "FullOuter" in plan


def test_stream_windows_are_partially_aggregated(spark, sf, tmp_path):
    spark.range(1).select(F.lit("{}").alias("value")).write.text(str(tmp_path / "log"))
    log = spark.readStream.format("text").load(str(tmp_path / "log"))
    stream = windowed_readings(readings.decode_readings(log))
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True
    ).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert plan.index("StateStoreSave") < plan.index("Exchange") < plan.rindex("partial_count")
