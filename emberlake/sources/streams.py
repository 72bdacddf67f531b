"""Message sources: a Kafka topic, or a folder of text files with the same ``value`` column."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


FILE_MESSAGES = 250_000


@dataclass(frozen=True)
class Topic:
    """Where messages come from or go to.

    ``format`` is ``kafka`` (``location`` is the topic) or ``text`` (``location``
    is a folder). ``per_trigger`` limits a micro-batch: offsets for Kafka,
    files for a folder. ``compression``: codec of files written
    to a folder; readers find out by themselves.
    """

    location: str
    format: str = "kafka"
    servers: str = "localhost:9092"
    per_trigger: int | None = None
    extra: dict[str, str] = field(default_factory=dict)
    compression: str = "gzip"

    def read_options(self, streaming: bool = True) -> dict[str, str]:
        if self.format != "kafka":
            limit = {"maxFilesPerTrigger": str(self.per_trigger)} if self.per_trigger and streaming else {}
            return {**limit, **self.extra}
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.location,
            "startingOffsets": "earliest",
            "failOnDataLoss": "false",
        }
        if self.per_trigger and streaming:
            options["maxOffsetsPerTrigger"] = str(self.per_trigger)
        return {**options, **self.extra}

    def write_options(self) -> dict[str, str]:
        if self.format == "kafka":
            return {"kafka.bootstrap.servers": self.servers, "topic": self.location}
        return {"path": self.location, **self.file_options()}

    def file_options(self) -> dict[str, str]:
        """Compressed files are read by one task each, so their length is bounded."""
        return {"compression": self.compression, "maxRecordsPerFile": str(FILE_MESSAGES)}


def send(messages: DataFrame, topic: Topic, mode: str = "errorifexists") -> None:
    """A static frame of message values into a topic."""
    writer = messages.write.format(topic.format).options(**topic.write_options())
    if topic.format == "kafka":
        writer.save()
    else:
        writer.mode(mode).save()


def _values(loaded: DataFrame) -> DataFrame:
    return loaded.select(F.col("value").cast("string").alias("value"))


def read_messages(spark: SparkSession, topic: Topic) -> DataFrame:
    """Unbounded message values as strings."""
    reader = spark.readStream.format(topic.format).options(**topic.read_options())
    return _values(reader.load() if topic.format == "kafka" else reader.load(topic.location))


def read_messages_once(spark: SparkSession, topic: Topic) -> DataFrame:
    """Everything in the topic now, as a static frame."""
    reader = spark.read.format(topic.format).options(**topic.read_options(streaming=False))
    return _values(reader.load() if topic.format == "kafka" else reader.load(topic.location))
