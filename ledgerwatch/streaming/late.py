"""Hourly totals per customer on a stream, with rows later than the watermark merged in instead of dropped.

A windowed aggregate loses what arrives after its watermark. This handler draws the same
line (newest event time of all earlier batches less the lateness bound), marks and
counts the rows behind it, and brings them into the stored totals: the hours that a
batch touches, on time or late, are added up anew from the stored rows and go
through the newest-wins merge. Only the days of these hours are read and rewritten.

A batch that is repeated after a failure replaces its own rows and comes to the same totals.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.snapshots import upsert_partitions
from ..sources.tables import create_if_missing, overwrite_partitions

_TS = "transaction_timestamp"
UNKNOWN = "UNKNOWN"
TOTALS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("hour", T.TimestampType()),
        T.StructField("amount", T.DecimalType(38, 2)),
        T.StructField("transactions", T.LongType()),
        T.StructField("late", T.LongType()),
        T.StructField("version", T.LongType()),
        T.StructField("transaction_date", T.DateType()),
    ]
)
_PROGRESS = T.StructType(
    [
        T.StructField("rows", T.LongType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("watermark", T.TimestampType()),
        T.StructField("newest", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class LatePaths:
    rows: str
    totals: str
    progress: str

    @classmethod
    def under(cls, base: str) -> LatePaths:
        return cls(*[f"{base.rstrip('/')}/{name}" for name in ("rows", "totals", "progress")])


def _newest_before(spark: SparkSession, paths: LatePaths, batch_id: int) -> datetime | None:
    """Newest event time up to the batch before, which that batch has stored."""
    if batch_id == 0:
        return None
    return spark.read.schema(_PROGRESS).parquet(f"{paths.progress}/batch_id={batch_id - 1}").first()["newest"]


def totals_handler(
    spark: SparkSession, paths: LatePaths, lateness: timedelta = timedelta(hours=2), amount: str = "amount_eur"
) -> Callable[[DataFrame, int], None]:
    """Handler for ``each_batch``; rows without a customer or a time count for UNKNOWN, or are only stored."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        newest = _newest_before(spark, paths, batch_id)
        watermark = newest - lateness if newest is not None else None
        late = F.coalesce(F.col(_TS) < F.lit(watermark), F.lit(False)) if watermark else F.lit(False)
        marked = batch.select("transaction_id", F.coalesce("customer_id", F.lit(UNKNOWN)).alias("customer_id"), _TS, F.col(amount).alias("amount"))
        marked = marked.withColumns({"late": late, "batch_id": F.lit(batch_id).cast("long"), "transaction_date": F.to_date(_TS)})
        overwrite_partitions(marked, paths.rows, ("transaction_date", "batch_id"))

        stored = spark.read.schema(marked.schema).parquet(paths.rows).filter(F.col("batch_id") <= batch_id)
        own = stored.filter(F.col("batch_id") == batch_id)
        place = {"hour": F.date_trunc("hour", _TS)}
        touched = own.filter(f"{_TS} IS NOT NULL").withColumns(place).select("transaction_date", "customer_id", "hour").distinct()
        rows = stored.withColumns(place).join(touched, ["transaction_date", "customer_id", "hour"], "left_semi")
        totals = rows.groupBy("transaction_date", "customer_id", "hour").agg(
            F.sum("amount").cast("decimal(38,2)").alias("amount"),
            F.count("*").alias("transactions"),
            F.count_if("late").alias("late"),
        )
        totals = totals.withColumn("version", F.lit(batch_id).cast("long")).select(*TOTALS.names)
        create_if_missing(spark, paths.totals, TOTALS, ("transaction_date",))
        upsert_partitions(spark, paths.totals, totals, ["customer_id", "hour"], "transaction_date", "version", TOTALS)

        n, n_late, own_newest = own.agg(F.count("*"), F.count_if("late"), F.max(_TS)).first()
        so_far = max((t for t in (newest, own_newest) if t is not None), default=None)
        line = spark.createDataFrame([(n, n_late, watermark, so_far)], _PROGRESS)
        line.coalesce(1).write.mode("overwrite").parquet(f"{paths.progress}/batch_id={batch_id}")

    return handle


def totals(spark: SparkSession, paths: LatePaths) -> DataFrame:
    return spark.read.schema(TOTALS).parquet(paths.totals)


def progress(spark: SparkSession, paths: LatePaths) -> DataFrame:
    """batch_id, rows, late_rows, watermark and newest of every batch."""
    return spark.read.schema(T.StructType([*_PROGRESS.fields, T.StructField("batch_id", T.LongType())])).parquet(paths.progress)
