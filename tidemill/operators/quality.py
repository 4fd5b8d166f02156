"""Quality gates, health reports, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numeric import share_pct
from tidemill.functions.sums import mean
from tidemill.functions.time import clock, minutes_between, on_day, since
from tidemill.operators.rollups import metric_rows, union_all

# Thresholds of the quality gates.
MIN_COMPLETENESS_PCT = 95.0
MAX_STALE_MINUTES = 90
MAX_NULL_LABEL_SHARE = 0.05


class QualityError(ValueError):
    """A quality gate is not met."""


def has_rows(df: DataFrame) -> bool:
    """Whether there is anything to do; stops at the first row found."""
    return not df.isEmpty()


def reading_quality(readings: DataFrame, as_of, hours: int = 3) -> DataFrame:
    """One row: completeness and freshness of the recent readings, and a verdict."""
    now = clock(as_of)
    measured = readings.where(since("event_time", as_of, f"{hours} HOUR")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("temperature_c").isNull()).alias("null_temp"),
        F.count_if(F.col("humidity_pct").isNull()).alias("null_humidity"),
        share_pct(F.col("temperature_c").isNotNull(), 2).alias("completeness_pct"),
        F.max("event_time").alias("latest_event"),
    )
    measured = measured.withColumn("minutes_since_last_event", minutes_between(F.col("latest_event"), now))
    verdict = (
        F.when(F.col("completeness_pct") < MIN_COMPLETENESS_PCT, "incomplete")
        .when(F.col("minutes_since_last_event") > MAX_STALE_MINUTES, "stale")
        .when(F.col("total_rows") == 0, "empty")
        .otherwise("ok")
    )
    return measured.withColumn("verdict", verdict)


def label_quality(posts: DataFrame, as_of) -> DataFrame:
    """One row: labels of the posts ingested on the day, and a verdict."""
    label = F.col("sentiment_label")
    measured = posts.where(on_day("ingested_at", as_of)).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(label.isNull()).alias("null_labels"),
        F.round(mean("sentiment_score"), 4).alias("avg_score"),
        F.count_if(label == "positive").alias("positive_count"),
        F.count_if(label == "negative").alias("negative_count"),
        F.count_if(label == "neutral").alias("neutral_count"),
    )
    share = F.try_divide(F.col("null_labels"), F.col("total"))
    return measured.withColumn("verdict", F.when(share > MAX_NULL_LABEL_SHARE, "unlabelled").otherwise("ok"))


def require(report: DataFrame) -> dict:
    """The one-row report as a dict; raises unless its verdict is ok or empty."""
    row = report.first().asDict()
    if row["verdict"] not in ("ok", "empty"):
        raise QualityError(f"quality gate not met: {row}")
    return row


def uptime_report(readings: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Completeness and active time per sensor and day."""
    return (
        readings.where(since("event_time", as_of, f"{hours} HOUR"))
        .groupBy("sensor_id", "city", F.to_date("event_time").alias("report_date"))
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_if(F.col("temperature_c").isNull()).alias("null_temp_count"),
            F.count_if(F.col("humidity_pct").isNull()).alias("null_humidity_count"),
            share_pct(F.col("temperature_c").isNotNull(), 1).alias("temp_completeness_pct"),
            F.min("event_time").alias("first_event"),
            F.max("event_time").alias("last_event"),
        )
        .withColumn("active_minutes", minutes_between(F.col("first_event"), F.col("last_event")))
        .orderBy("city", F.col("report_date").desc(), "sensor_id")
    )


def post_health(posts: DataFrame, as_of) -> DataFrame:
    """Ingestion health as (metric, value) rows, from one pass."""
    today = on_day("ingested_at", as_of)
    measures = posts.agg(
        F.max("ingested_at").alias("last"),
        F.count_if(since("ingested_at", as_of, "1 HOUR")).alias("hour"),
        F.count_if(today).alias("day"),
        F.count_if(today & F.col("sentiment_label").isNull()).alias("unlabelled"),
    )
    return metric_rows(
        measures,
        {
            "Last ingestion": "last",
            "Posts last hour": "hour",
            "Total posts today": "day",
            "Null sentiment labels": "unlabelled",
        },
    )


def layer_health(speed: DataFrame, candles: DataFrame, as_of) -> DataFrame:
    """Row count and note per layer.  Both layers are readable here, so the
    speed layer gets a real count next to the typed NULL of its note."""
    recent = speed.where(since("event_time", as_of, "1 HOUR")).agg(
        F.lit("speed layer (latest 1h)").alias("layer"),
        F.count(F.lit(1)).cast("int").alias("record_count"),
    )
    day = clock(as_of).cast("date")
    batch = candles.where(F.col("batch_date") == day).agg(
        F.lit("batch layer (today)").alias("layer"),
        F.count(F.lit(1)).cast("int").alias("record_count"),
        F.max(F.col("loaded_at").cast("string")).alias("note"),
    )
    return union_all(recent.withColumn("note", F.lit(None).cast("string")), batch)


def layer_inventory(layers: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """(schema, table, frame, load time column) to row count and last change."""
    return union_all(
        *[
            df.agg(
                F.lit(schema).alias("table_schema"),
                F.lit(table).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.max(changed).alias("last_altered"),
            )
            for schema, table, df, changed in layers
        ]
    ).orderBy("table_schema", "table_name")


def reconcile(extracted: DataFrame, staged: DataFrame, loaded: DataFrame, by: str) -> DataFrame:
    """Row counts of the three stages side by side, per slice."""
    stages = union_all(
        extracted.select(by, F.lit("records_extracted").alias("stage")),
        staged.select(by, F.lit("records_staged").alias("stage")),
        loaded.select(by, F.lit("records_loaded").alias("stage")),
    )
    names = ["records_extracted", "records_staged", "records_loaded"]
    counts = stages.groupBy(by).agg(*[F.count_if(F.col("stage") == n).alias(n) for n in names])
    complete = (F.col(names[0]) == F.col(names[1])) & (F.col(names[1]) == F.col(names[2]))
    return counts.withColumn("status", F.when(complete, "SUCCESS").otherwise("MISMATCH"))
