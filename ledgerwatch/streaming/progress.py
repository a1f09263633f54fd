"""Progress metrics of running queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

_PROGRESS = T.StructType(
    [
        T.StructField("query_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("rows_per_second", T.DoubleType()),
        T.StructField("trigger_ms", T.LongType()),
    ]
)


class ProgressLog(StreamingQueryListener):
    """Collects progress reports until the job appends them to a table."""

    def __init__(self):
        self.reports: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        duration = int(p.durationMs.get("triggerExecution", 0))
        self.reports.append((p.name, p.batchId, p.numInputRows, p.processedRowsPerSecond, duration))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def append_to(self, spark: SparkSession, path: str) -> None:
        """Append the reports so far to a table; call it as often as memory on the driver demands."""
        taken = list(self.reports)
        if taken:
            spark.createDataFrame(taken, _PROGRESS).coalesce(1).write.mode("append").parquet(path)
            del self.reports[: len(taken)]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.reports, _PROGRESS)
