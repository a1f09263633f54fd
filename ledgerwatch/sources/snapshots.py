"""Tables with numbered snapshots: read any version, list the history, upsert.

A snapshot is one ``snapshot_version=N`` folder. It becomes visible when its
line is added to the small history table next to it. Two writers of the same
version cannot both succeed: the folder is created once. One that is left behind by
a failed write has to be removed before that version can be written again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.grouping import keep_latest
from ..operators.merge import newest_wins, upsert
from ..operators.quality import counted
from .tables import create_if_missing, read_table

_HISTORY = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("row_count", T.LongType()),
    ]
)


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    @property
    def _history_path(self) -> str:
        return f"{self.path}_history"

    def history(self, limit: int | None = None) -> DataFrame:
        """Committed versions, newest first."""
        log = create_if_missing(self.spark, self._history_path, _HISTORY).orderBy(F.desc("version"))
        return log if limit is None else log.limit(limit)

    def resolve(self, version: int | None = None, timestamp: datetime | None = None) -> int | None:
        """Version number to read: the given one, the last at a time, or the newest."""
        log = self.history()
        if version is not None:
            log = log.filter(F.col("version") == version)
        if timestamp is not None:
            log = log.filter(F.col("committed_at") <= F.lit(timestamp))
        return log.agg(F.max("version")).first()[0]

    def exists(self) -> bool:
        return self.resolve() is not None

    def read(self, version: int | None = None, timestamp: datetime | None = None) -> DataFrame:
        found = self.resolve(version, timestamp)
        if found is None:
            raise LookupError(f"{self.path} has no snapshot for version={version}, timestamp={timestamp}")
        return self.spark.read.parquet(self._folder(found))

    def _folder(self, version: int) -> str:
        return f"{self.path}/snapshot_version={version}"

    def commit(
        self, df: DataFrame, at: datetime, operation: str = "WRITE", partition_by: tuple[str, ...] = ()
    ) -> int:
        """Store ``df`` as the next version and return its number."""
        latest = self.resolve()
        version = 0 if latest is None else latest + 1
        observed, rows = counted(df, f"snapshot-{version}")
        # A second writer of the same version fails here; so does a repeat after a failed write, until its folder is gone.
        observed.write.mode("errorifexists").partitionBy(*partition_by).parquet(self._folder(version))
        line = [(version, at, operation, rows.get["rows"])]
        self.spark.createDataFrame(line, _HISTORY).coalesce(1).write.mode("append").parquet(self._history_path)
        return version

    def upsert(self, source: DataFrame, keys: list[str], at: datetime) -> int:
        """Update matching keys, insert the rest; the first call creates the table."""
        order = [F.col(c).desc_nulls_last() for c in source.columns if c not in keys]
        unique = keep_latest(source, keys, order or [F.col(keys[0])])
        if not self.exists():
            return self.commit(unique, at, "CREATE")
        return self.commit(upsert(self.read(), unique, keys), at, "UPSERT")


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition: str,
    newer_by: str | None = None,
    schema: T.StructType | None = None,
) -> None:
    """Upsert into a date-partitioned table, rewriting only the touched partitions.

    With ``newer_by``, a stored row gives way only to a newer one: the way to
    bring in rows that arrived too late for a stream.

    The partition value must be fixed by the key (a transaction keeps its date).
    Untouched partitions are neither read (partition pruning on the join) nor
    written (dynamic overwrite stages the new files before swapping them in).
    ``schema`` is needed while the table has no files yet.
    """
    target = read_table(spark, path, schema=schema)
    touched = source.select(partition).distinct()
    affected = target.join(touched, partition, "left_semi")
    if newer_by is None:
        merged = upsert(affected, source, keys)
    else:
        merged = newest_wins(affected, source, keys, newer_by)
    merged = merged.select(*target.columns)
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
