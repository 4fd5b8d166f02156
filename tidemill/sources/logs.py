"""Event logs: a ``value`` column of JSON text, read as a stream or bounded."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Log:
    """Where a log lives.

    ``kafka`` subscribes to ``name``.  ``text`` reads files of one JSON record
    per line under the path ``name``; both give the same ``value`` column.
    ``intake`` limits what one trigger takes: offsets for kafka, files for text.
    """

    name: str
    format: str = "kafka"
    options: dict[str, str] = field(default_factory=dict)
    intake: int | None = None

    @property
    def is_kafka(self) -> bool:
        return self.format == "kafka"


def stream_options(log: Log) -> dict[str, str]:
    """Reader options of an unbounded read that starts at the newest records."""
    options = dict(log.options)
    if log.is_kafka:
        options = {"subscribe": log.name, "startingOffsets": "latest"} | options
    if log.intake:
        options["maxOffsetsPerTrigger" if log.is_kafka else "maxFilesPerTrigger"] = str(log.intake)
    return options


def bounded_options(log: Log) -> dict[str, str]:
    """Reader options of a scan over everything the log holds.

    ``minPartitions`` (in ``log.options``) splits the offset range of a topic
    partition over several tasks, so that one hot partition is not one task.
    """
    if not log.is_kafka:
        return dict(log.options)
    return {
        "subscribe": log.name,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    } | log.options


def open_stream(spark: SparkSession, log: Log) -> DataFrame:
    reader = spark.readStream.format(log.format).options(**stream_options(log))
    return (reader.load() if log.is_kafka else reader.load(log.name)).select("value")


def read_log(spark: SparkSession, log: Log) -> DataFrame:
    reader = spark.read.format(log.format).options(**bounded_options(log))
    return (reader.load() if log.is_kafka else reader.load(log.name)).select("value")
