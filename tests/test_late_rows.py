"""Late rows, open windows and timed runs."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from tidemill import jobs
from tidemill.plans.readings import decode_readings, five_minute_windows
from tidemill.sources.logs import Log, open_stream
from tidemill.streaming.jobs import (
    AccountedWindows, LiveWindows, ReadingBatches, caught_up, run, serve, start, stop_orderly, windowed_readings,
)
from tests.test_streams import START, reading, send

DELIVERIES = [
    [reading(m, temperature=float(m)) for m in range(20)],
    [reading(60), {**reading(61), "event_time": None}],
    # The watermark is at minute 58 now: the window up to 55 is closed, that up to 60 is open.
    [reading(3, temperature=99.0), reading(54), reading(57), reading(62)],
    [{**reading(5), "event_time": "soon"}, reading(100)],
    [reading(59, sensor="other"), reading(97)],
]


@pytest.fixture
def accounted(tmp_path):
    return AccountedWindows(*(str(tmp_path / name) for name in ("states", "late", "marks")))


def decoded(spark, records):
    return decode_readings(spark.createDataFrame([(json.dumps(r),) for r in records], "value STRING"))


def stream_of(spark, log):
    return decode_readings(open_stream(spark, Log(str(log), "text", intake=1)))


def test_every_row_is_in_a_window_or_late(spark, rows, tmp_path, accounted):
    """The windows are those of the stateful aggregate; what that drops is in the late table."""
    log, out = tmp_path / "log", str(tmp_path / "out")
    for i, delivery in enumerate(DELIVERIES):
        send(log, f"{i}.txt", delivery)
        run(stream_of(spark, log), str(tmp_path / "a"), body=accounted)
        run(windowed_readings(stream_of(spark, log)), str(tmp_path / "b"), path=out)
    late = accounted.late_rows(spark)
    assert late.count() == 5
    assert accounted.counts(spark) == {"sent": 30, "in_time": 25, "late": 3, "untimed": 2}
    assert accounted.windows(spark).agg(F.sum("reading_count")).first()[0] == 25
    times = sorted(r[0] for r in late.where("event_time IS NOT NULL").select("event_time").collect())
    assert times == [START + dt.timedelta(minutes=m) for m in (3, 54, 59)]
    send(log, "9.txt", [reading(1000)])  # closes all windows of the stateful query
    run(windowed_readings(stream_of(spark, log)), str(tmp_path / "b"), path=out)
    send(log, "99.txt", [reading(1001)])
    run(windowed_readings(stream_of(spark, log)), str(tmp_path / "b"), path=out)
    assert rows(spark.read.parquet(out)) == rows(accounted.windows(spark))


def test_a_replayed_batch_decides_as_before(spark, rows, accounted):
    batches = [decoded(spark, part) for part in DELIVERIES[:3]]
    for i, batch in enumerate(batches):
        accounted(batch, i)
    before = rows(accounted.late_rows(spark)), rows(accounted.windows(spark)), accounted.counts(spark)
    accounted(batches[2], 2)
    assert (rows(accounted.late_rows(spark)), rows(accounted.windows(spark)), accounted.counts(spark)) == before


def test_old_marks_go(spark, tmp_path):
    body = AccountedWindows(*(str(tmp_path / n) for n in ("states", "late", "marks")), kept_marks=2)
    batch = decoded(spark, [reading(0)])
    for i in range(5):
        body(batch, i)
    assert sorted(r[0] for r in spark.read.parquet(body.marks).select("batch_id").collect()) == [2, 3, 4]
    assert body.counts(spark)["sent"] == 5


def test_open_windows_are_visible(spark, rows, tmp_path):
    log, live = tmp_path / "log", LiveWindows(str(tmp_path / "live"))
    sent = [[reading(0), reading(1, temperature=3.0)], [reading(2, temperature=5.0)]]
    sent.append([reading(7), {**reading(3), "city": None}])
    for i, part in enumerate(sent):
        send(log, f"{i}.txt", part)
        run(windowed_readings(stream_of(spark, log)), str(tmp_path / "cp"), body=live, mode="update")
        seen = [r for some in sent[: i + 1] for r in some]
        assert rows(live.windows(spark)) == rows(five_minute_windows(decoded(spark, seen)))


def test_window_jobs(spark, tmp_path):
    send(tmp_path / "log", "1.txt", DELIVERIES[0])
    log = Log(str(tmp_path / "log"), "text")
    jobs.watch_live_windows(spark, log, str(tmp_path / "live"), every=None).awaitTermination()
    jobs.watch_accounted_windows(spark, log, str(tmp_path / "acc"), every=None).awaitTermination()
    assert LiveWindows(str(tmp_path / "live/live_windows")).windows(spark).count() == 4
    assert spark.read.parquet(str(tmp_path / "acc/marks")).first()["sent"] == 20


def gate(tmp_path):
    return ReadingBatches(*(str(tmp_path / n) for n in ("raw", "windows", "quarantine")))


def test_a_timed_query_stops_and_resumes(spark, tmp_path):
    log, body = tmp_path / "log", gate(tmp_path)
    for i in range(2):
        send(log, f"{i}.txt", [reading(m + 10 * i) for m in range(5)])
        query = serve(stream_of(spark, log), str(tmp_path / "cp"), "1 second", caught_up(5), body=body)
        assert not query.isActive and query.exception() is None
    assert spark.read.parquet(body.raw).count() == 10


def test_a_batch_that_has_begun_is_finished(spark, tmp_path):
    log, done = tmp_path / "log", []

    def slow(batch, batch_id):
        time.sleep(3)
        done.append(batch.count())

    send(log, "1.txt", [reading(1)])
    query = start(stream_of(spark, log), str(tmp_path / "cp"), body=slow, every="1 second")
    while not query.status["isTriggerActive"]:
        time.sleep(0.02)
    stop_orderly(query)
    assert done == [1] and [x["numInputRows"] for x in query.recentProgress if x["numInputRows"]] == [1]


def test_failures_and_silence_end_a_timed_run(spark, tmp_path):
    log = tmp_path / "log"
    send(log, "1.txt", [reading(1)])

    def broken(batch, batch_id):
        raise RuntimeError("no")

    with pytest.raises(Exception, match="no"):
        serve(stream_of(spark, log), str(tmp_path / "a"), "1 second", caught_up(1), body=broken)
    with pytest.raises(TimeoutError):
        serve(stream_of(spark, log), str(tmp_path / "b"), "1 second", caught_up(9, 3.0), body=gate(tmp_path))
    assert not spark.streams.active
