"""Starting and finishing streaming writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def _trigger(writer, every: str | None):
    """Every ``every`` (for example "10 seconds"), or all available data once."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append-mode table sink with its own checkpoint."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, every).start(path)


def publish(
    messages: DataFrame,
    options: dict[str, str],
    checkpoint: str,
    fmt: str = "kafka",
    every: str | None = None,
) -> StreamingQuery:
    """Send key/value rows, such as routed alerts, to a topic."""
    writer = messages.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    return _trigger(writer.outputMode("append"), every).start()


def each_batch(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, every).start()


def finish(query: StreamingQuery) -> None:
    """Wait for a query that processes what is available and then ends."""
    query.awaitTermination()
    if (problem := query.exception()) is not None:
        raise problem


def run_until_stopped(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Block until any query ends, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
