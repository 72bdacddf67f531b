"""Starting, bounding and stopping streaming queries."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

INGEST_TRIGGER = "5 seconds"
ARCHIVE_TRIGGER = "10 seconds"


# State in RocksDB, whose memory in an executor is bounded as a whole.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started in the block keep their state on executors' disks; else every key lives in their heaps."""
    before = {key: spark.conf.get(key, None) for key in STATE_ON_DISK}
    try:
        for key, value in STATE_ON_DISK.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start(writer: DataStreamWriter, interval: str = INGEST_TRIGGER) -> StreamingQuery:
    return writer.trigger(processingTime=interval).start()


def drain(*writers: DataStreamWriter) -> list[StreamingQuery]:
    """Process what is there now, side by side, and stop. The ended queries still tell their progress."""
    queries = [w.trigger(availableNow=True).start() for w in writers]
    for query in queries:
        query.awaitTermination()
    return queries


def choose(writers: dict[str, DataStreamWriter], mode: str) -> list[DataStreamWriter]:
    """``both`` or the name of one stream."""
    if mode == "both":
        return list(writers.values())
    return [writers[mode]]


def run(spark: SparkSession, writers: list[DataStreamWriter], seconds: int = 0,
        interval: str = INGEST_TRIGGER) -> None:
    """Run until ``seconds`` have passed (0: no limit) or any query fails, then stop all."""
    spark.streams.resetTerminated()
    queries = [start(w, interval) for w in writers]
    try:
        if seconds > 0:
            spark.streams.awaitAnyTermination(seconds)
        else:
            spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
