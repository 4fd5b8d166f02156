"""Structured Streaming jobs.  A stream is source -> the batch transforms -> sink.

Every sink write is keyed by ``batch_id`` or by the record key, so a batch that
is replayed after a failure replaces its own earlier output.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions.numeric import outlier
from tidemill.functions.sums import mean, stddev, with_products
from tidemill.operators.dedup import latest_per_key
from tidemill.operators.merge import BATCH, add_delta, current, settle
from tidemill.plans.posts import SENTIMENT_FIELDS, score_posts
from tidemill.plans.prices import LATEST_FIELDS
from tidemill.plans.readings import ANOMALY_LIMIT, five_minute_windows, window_state, windows_of_states
from tidemill.sinks.tables import drop_slices, read_slices, replace_slice, slices_of

# Fixed value: share of readings with a temperature that a batch needs.
MIN_COMPLETENESS = 0.95

CREATED_DAY = "created_date"
POST_ORDER = [BATCH, "ingested_at", "score", "sentiment_score"]
PRICE_ORDER = ["event_time", "current_price_usd"]


def windowed_readings(
    readings: DataFrame,
    delay: str = "2 minutes",
    width: str = "5 minutes",
    keys: Sequence[str] = ("city",),
) -> DataFrame:
    """Stateful tumbling windows.  Partial aggregation precedes the exchange to
    the state store, and rows later than ``delay`` are dropped."""
    return five_minute_windows(readings.withWatermark("event_time", delay), keys, width)


def start(
    stream: DataFrame,
    checkpoint: str,
    body: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None,
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Start a query into a ``foreachBatch`` body or a Parquet folder.

    ``every`` is a processing-time interval; without it the query takes what is
    available, in intake-sized batches, and stops.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if body is not None:
        return writer.foreachBatch(body).start()
    return writer.format("parquet").option("path", path).start()


def run(stream: DataFrame, checkpoint: str, **sink) -> None:
    """Process everything available, then return."""
    start(stream, checkpoint, **sink).awaitTermination()


def stop_orderly(query: StreamingQuery, patience: float = 600.0) -> None:
    """Stops a query between two batches instead of in the middle of one.

    A batch that has begun is finished and committed first, within ``patience`` seconds; a
    query that resumes from the checkpoint then goes on with the next one.
    """
    until = time.monotonic() + patience
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.05)
    query.stop()


def serve(
    stream: DataFrame, checkpoint: str, every: str, enough: Callable[[StreamingQuery], bool], look: float = 0.2, **sink
) -> StreamingQuery:
    """Runs a query by its timer until ``enough`` (asked every ``look`` seconds), then stops it orderly.

    A failed batch raises here.  The query is returned for its progress.
    """
    query = start(stream, checkpoint, every=every, **sink)
    try:
        while not query.awaitTermination(look) and not enough(query):
            pass
    finally:
        stop_orderly(query)
    return query


def caught_up(rows: int, seconds: float = 120.0) -> Callable[[StreamingQuery], bool]:
    """True once a query's batches have read so many rows; an error after ``seconds``."""
    until = time.monotonic() + seconds

    def enough(query: StreamingQuery) -> bool:
        if time.monotonic() > until:
            raise TimeoutError(f"{rows} rows were not read within {seconds} seconds")
        return sum({x["batchId"]: x["numInputRows"] for x in query.recentProgress}.values()) >= rows

    return enough


@contextmanager
def held(batch: DataFrame):
    """The batch kept for several passes, with adaptive execution for its writes.

    Spark turns adaptive execution off in the session of a stateful query.  The
    stateful part of a batch is planned before the body runs, so what the body
    adds can be adaptive: hot slices are split, small ones are put together.
    """
    conf = batch.sparkSession.conf
    before = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "true")
    batch = batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()
        conf.set("spark.sql.adaptive.enabled", before)


@dataclass(frozen=True)
class ReadingBatches:
    """Quality gate, anomaly flag, raw rows and window states of each batch.

    One aggregate pass answers the emptiness test, the gate and the statistics;
    the batch is kept in memory or on local disk between the passes.  A batch
    below the gate goes to quarantine instead of being lost.  Tables are split
    by day, then batch: reports read days, a replay replaces its batch.
    """

    raw: str
    windows: str
    quarantine: str
    min_completeness: float = MIN_COMPLETENESS

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with held(batch.withColumn("batch_id", F.lit(batch_id))) as rows:
            stats = with_products(rows, ("temperature_c", "temperature_c")).agg(
                F.count(F.lit(1)).alias("rows"),
                F.count("temperature_c").alias("measured"),
                mean("temperature_c").alias("mean"),
                stddev("temperature_c").alias("std"),
            ).first()
            if stats["rows"] == 0:
                return
            if stats["measured"] / stats["rows"] < self.min_completeness:
                replace_slice(rows, self.quarantine, ["batch_id"], one_slice=True)
                return
            anomaly = outlier(
                "temperature_c", F.lit(stats["mean"]).cast("double"), F.lit(stats["std"]).cast("double"), ANOMALY_LIMIT
            )
            flagged = rows.withColumns({"is_anomaly": anomaly, "event_date": F.to_date("event_time")})
            replace_slice(flagged, self.raw, ["event_date", "batch_id"], ["sensor_id", "event_time"])
            state = window_state(rows).withColumns(
                {"window_date": F.to_date("window_start"), "batch_id": F.lit(batch_id)}
            )
            replace_slice(state, self.windows, ["window_date", "batch_id"])


WINDOW_KEYS = ["window_start", "window_end", "city"]


@dataclass(frozen=True)
class LiveWindows:
    """Keeps the windows that an update-mode query sends after every batch.

    A batch writes the windows it has changed, split by day; ``windows`` reads the newest
    state of each, also of those that the watermark has not closed.
    """

    path: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with held(batch.withColumn("window_date", F.to_date("window_start"))) as rows:
            if not rows.isEmpty():
                add_delta(rows, self.path, batch_id, ["window_date"])

    def windows(self, spark: SparkSession) -> DataFrame:
        return latest_per_key(spark.read.parquet(self.path), WINDOW_KEYS, [BATCH]).drop(BATCH, "window_date")


@dataclass(frozen=True)
class AccountedWindows:
    """Window states of the rows in time; rows that come too late are kept apart and counted.

    The rule is that of a watermark: a batch's watermark lies ``delay`` behind the greatest
    event time of the batches before it, and a row is late if its window has ended by then.
    A stateful aggregate drops such rows and tells a number of partial groups at most; here
    every row sent is in a window, in the late table, or, without a time, in the late table
    without a watermark.  A batch's mark holds the running maximum and running counts, so only
    the newest mark before a batch is read, and a replayed batch decides as it did before.
    """

    states: str
    late: str
    marks: str
    delay: str = "2 minutes"
    width: str = "5 minutes"
    kept_marks: int = 100

    def _mark_before(self, spark: SparkSession, batch_id: int | None) -> dict:
        found = [x for x in slices_of(spark, self.marks, [BATCH]) if batch_id is None or int(x.values[0]) < batch_id]
        if not found:
            return {"newest": None, "sent": 0, "in_time": 0, "late": 0, "untimed": 0}
        newest = max(found, key=lambda x: int(x.values[0]))
        return read_slices(spark, self.marks, [newest], {}).first().asDict()

    def counts(self, spark: SparkSession) -> dict[str, int]:
        """Rows sent so far, and where they went."""
        mark = self._mark_before(spark, None)
        return {k: mark[k] for k in ("sent", "in_time", "late", "untimed")}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = self._mark_before(spark, batch_id)
        newest = F.lit(mark["newest"]).cast(batch.schema["event_time"].dataType)
        watermark = newest - F.expr(f"INTERVAL {self.delay}")
        timed = F.col("event_time").isNotNull()
        with held(batch.withColumn(BATCH, F.lit(batch_id))) as rows:
            # ``window`` keeps rows with a time only.  Without a mark before it a batch has no watermark.
            told = rows.where(timed).withColumns({"watermark": watermark, "window": F.window("event_time", self.width)})
            is_late = F.coalesce(F.col("window.end") <= F.col("watermark"), F.lit(False))
            late, in_time = (told.where(x).drop("window") for x in (is_late, ~is_late))
            apart = late.unionByName(rows.where(~timed), allowMissingColumns=True)
            state = window_state(in_time, width=self.width)
            state = state.withColumns({"window_date": F.to_date("window_start"), BATCH: F.lit(batch_id)})
            replace_slice(state, self.states, ["window_date", BATCH])
            replace_slice(apart, self.late, [BATCH], one_slice=True)
            seen = rows.agg(
                F.max("event_time").cast("string").alias("newest"), F.count("event_time").alias("timed"),
                F.count(F.lit(1)).alias("sent"),
            ).first()
            n_late = late.count()
            found = {"sent": seen["sent"], "in_time": seen["timed"] - n_late, "late": n_late}
            found["untimed"] = seen["sent"] - seen["timed"]
            times = [x for x in (mark["newest"], seen["newest"]) if x is not None]
            row = (max(times, default=None), *(mark[k] + n for k, n in found.items()), batch_id)
            marks = spark.createDataFrame([row], f"newest STRING, {', '.join(f'{k} LONG' for k in found)}, {BATCH} INT")
            replace_slice(marks, self.marks, [BATCH], one_slice=True)
        drop_slices(spark, self.marks, BATCH, lambda x: int(x) < batch_id - self.kept_marks)

    def windows(self, spark: SparkSession) -> DataFrame:
        return windows_of_states(spark.read.parquet(self.states))

    def late_rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.late)


@dataclass(frozen=True)
class PostBatches:
    """Scores posts and upserts the raw and the sentiment documents by post id.

    A batch writes its own rows only, split by creation day; ``current_posts`` and
    ``current_sentiment`` read one row per post, and ``settle`` folds the batches.
    """

    lexicon: Mapping[str, tuple[float, float]]
    posts: str
    sentiment: str
    null_overwrites: bool = False

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        scored = score_posts(batch, self.lexicon).withColumns(
            {"batch_id": F.lit(batch_id), CREATED_DAY: F.col("created_utc").cast("date")}
        )
        with held(scored) as rows:
            if rows.isEmpty():
                return
            documents = rows.select(*SENTIMENT_FIELDS, "ingested_at", CREATED_DAY)
            for path, updates in ((self.posts, rows), (self.sentiment, documents)):
                add_delta(updates, path, batch_id, [CREATED_DAY], ["post_id"])

    def _current(self, spark: SparkSession, path: str) -> DataFrame:
        return current(spark.read.parquet(path), ["post_id"], POST_ORDER, not self.null_overwrites)

    def current_posts(self, spark: SparkSession) -> DataFrame:
        return self._current(spark, self.posts)

    def current_sentiment(self, spark: SparkSession) -> DataFrame:
        return self._current(spark, self.sentiment)

    def settle(self, spark: SparkSession) -> None:
        for path in (self.posts, self.sentiment):
            settle(spark, path, ["post_id"], POST_ORDER, not self.null_overwrites, [CREATED_DAY])


@dataclass(frozen=True)
class PriceBatches:
    """Appends price events to the time series and keeps the latest price of each key.

    A batch adds its own latest rows; ``current_prices`` reads one row per key, and
    ``settle`` folds the batches.
    """

    series: str
    latest: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with held(batch.withColumn("batch_id", F.lit(batch_id))) as rows:
            if rows.isEmpty():
                return
            dated = rows.withColumn("event_date", F.col("event_time").cast("date"))
            replace_slice(dated, self.series, ["event_date", "batch_id"], ["coin_id", "event_time"])
            add_delta(current(rows.select(*LATEST_FIELDS), ["coin_id"], PRICE_ORDER, False), self.latest, batch_id)

    def current_prices(self, spark: SparkSession) -> DataFrame:
        return current(spark.read.parquet(self.latest).drop(BATCH), ["coin_id"], PRICE_ORDER, False)

    def settle(self, spark: SparkSession) -> None:
        settle(spark, self.latest, ["coin_id"], PRICE_ORDER, False)
