"""Stream sinks and the tables they fill.

A micro-batch that is run again after a failure writes to the same place, so its
output appears once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidewell.config import StreamConfig
from tidewell.functions import ordered
from tidewell.session import STREAM_SETTINGS


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """Stream settings while a stream starts, which takes them over; then the session is as before."""
    before = {key: spark.conf.get(key, None) for key in STREAM_SETTINGS}
    for key, value in STREAM_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start(
    writer, checkpoint: str, available_now: bool = False, trigger_seconds: int = StreamConfig.trigger_seconds
) -> StreamingQuery:
    """Start a stream. With `available_now` it takes what is there, and ends."""
    writer = writer.option("checkpointLocation", checkpoint)
    with stream_settings(SparkSession.active()):
        if not available_now:
            return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_files(stream: DataFrame, path: str, partition_by: str | None = None):
    """Append rows to a parquet folder, each exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return writer.partitionBy(partition_by) if partition_by else writer


def batches_to(path: str, transform: Callable[[DataFrame, int], DataFrame] | None = None):
    """A foreachBatch function that writes each micro-batch to its own subfolder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch, batch_id) if transform else batch
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All micro-batches written so far, with `batch_id`."""
    full = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def latest_per_key(table: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Of each key the row from the last micro-batch that had it, or the greatest by `order`."""
    return ordered.latest(table, keys, [F.col(name) for name in order or ["batch_id"]])


class StreamMetrics(StreamingQueryListener):
    """What streams report as they go: rows dropped behind the watermark, and how far they lag behind their sources.

    Register it with `spark.streams.addListener`. Each micro-batch of a stream counts once, over the stream's whole
    life in this session. What an aggregation drops is counted after rows of one group have met.
    """

    def __init__(self) -> None:
        self._dropped: dict[tuple[str, int], int] = {}
        self._lag: dict[tuple[str, str, str], int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        query = str(progress["id"])
        dropped = sum(int(state.get("numRowsDroppedByWatermark", 0)) for state in progress.get("stateOperators", []))
        self._dropped[query, progress["batchId"]] = dropped
        for source in progress.get("sources", []):
            for (topic, partition), rows in source_lag(source).items():
                self._lag[query, topic, partition] = rows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def dropped(self, query: StreamingQuery) -> int:
        """Rows the stream has dropped because they came after the watermark."""
        return sum(rows for (of, _), rows in self._dropped.items() if of == str(query.id))

    def lag(self, query: StreamingQuery) -> dict[tuple[str, str], int]:
        """Records not processed yet, by topic and partition, as of the last micro-batch."""
        return {(topic, partition): rows for (of, topic, partition), rows in self._lag.items() if of == str(query.id)}


def source_lag(source: dict) -> dict[tuple[str, str], int]:
    """Latest less processed offset of each partition of a source that has offsets by topic and partition."""

    def offsets(name: str) -> dict:
        value = source.get(name)
        value = json.loads(value) if isinstance(value, str) and value.startswith("{") else value
        return value if isinstance(value, dict) and all(isinstance(v, dict) for v in value.values()) else {}

    done = offsets("endOffset")
    return {
        (topic, partition): int(latest) - int(done.get(topic, {}).get(partition, 0))
        for topic, partitions in offsets("latestOffset").items() for partition, latest in partitions.items()
    }
