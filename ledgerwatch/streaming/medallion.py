"""Messages to bronze, silver and alert tables, micro-batch by micro-batch.

Bronze holds every message; those that break the contract are in its
``quarantined=true`` partitions, with the clauses they break.

A transaction that an earlier batch has stored is not stored or counted again. A
late row is counted in its own frame; alerts of later rows that are already stored
are not evaluated again.

Every write replaces the partitions of its own batch id, so a batch that is
repeated after a failure leaves each table as if it had run once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RuleConfigA, ScaleConfig
from ..operators import ingest, rules, velocity
from ..plans.alerting import Dimensions, build_silver
from ..sources.tables import create_if_missing, overwrite_partitions


@dataclass(frozen=True)
class MedallionPaths:
    bronze: str
    silver: str
    alerts: str

    @classmethod
    def under(cls, base: str) -> MedallionPaths:
        return cls(*[f"{base.rstrip('/')}/{name}" for name in ("bronze", "silver", "alerts")])


def batch_handler(
    dims: Dimensions | Callable[[], Dimensions],
    cfg: RuleConfigA,
    paths: MedallionPaths,
    scale: ScaleConfig = ScaleConfig(),
    publish: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Handler for ``each_batch`` over a stream of parsed messages.

    ``dims`` as a function is asked anew in every batch, so that a long run sees
    refreshed customers and rates. ``publish`` gets the stored alerts of a batch.

    Once a batch has landed, the rest runs in the session of the dimensions:
    the session of a stream has adaptive execution, and with it the handling of
    skewed joins, switched off.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = dims() if callable(dims) else dims
        spark = now.customers.sparkSession
        checked = ingest.contract_violations(batch).withColumns(
            {"batch_id": F.lit(batch_id), "quarantined": F.size("violations") > 0}
        )
        overwrite_partitions(checked, paths.bronze, ("ingestion_date", "batch_id", "quarantined"))

        landed = spark.read.schema(checked.schema).parquet(paths.bronze)
        bronze = landed.filter((F.col("batch_id") == batch_id) & ~F.col("quarantined"))
        bronze = bronze.drop("violations", "quarantined")
        silver = build_silver(bronze, now, cfg)
        placed = ("transaction_date", "batch_id")
        before = create_if_missing(spark, paths.silver, silver.schema, placed).filter(F.col("batch_id") < batch_id)
        # Messages delivered again: their first copy is stored under the same date.
        days = silver.select("transaction_date").distinct()
        known = before.join(days, "transaction_date", "left_semi").select("transaction_id")
        silver = silver.join(known, "transaction_id", "left_anti").select(*silver.columns)
        overwrite_partitions(silver, paths.silver, placed)

        stored = spark.read.schema(silver.schema).parquet(paths.silver)
        alerts = batch_alerts(stored, batch_id, cfg, scale)
        if alerts is not None:
            overwrite_partitions(alerts, paths.alerts, ("alert_date", "batch_id"))
            if publish is not None:
                written = spark.read.schema(alerts.schema).parquet(paths.alerts)
                publish(written.filter(F.col("batch_id") == batch_id), batch_id)

    return handle


def batch_velocity(
    stored: DataFrame, batch_id: int, cfg: RuleConfigA, scale: ScaleConfig = ScaleConfig()
) -> DataFrame | None:
    """The transactions of one batch with their trailing frame over all stored ones.

    The table is the state: only its partitions within one frame of the batch's days
    are read, and the sums are spread over time slices, so a customer with most
    of the rows is no bottleneck. None for a batch without transactions.
    """
    own = F.col("batch_id") == batch_id
    first, last = stored.filter(own).agg(F.min("transaction_timestamp"), F.max("transaction_timestamp")).first()
    if first is None:
        return None
    start = first - timedelta(hours=cfg.velocity_window_hours)
    # Days with rows of the batch and those its frames reach back to; a late row reads its own.
    back = -(-cfg.velocity_window_hours // 24)
    reach = F.explode(F.sequence(F.date_sub("transaction_date", back), "transaction_date"))
    days = stored.filter(own).select("transaction_date").distinct().select(reach.alias("transaction_date")).distinct()
    nearby = stored.filter(
        F.col("transaction_date").between(F.lit(start.date()), F.lit(last.date()))
        & F.col("transaction_timestamp").between(F.lit(start), F.lit(last))
        & (F.col("batch_id") <= batch_id)
    ).join(days, "transaction_date", "left_semi")
    return velocity.trailing_velocity(nearby, cfg, scale.velocity_slice_minutes, wanted=own)


def batch_alerts(
    silver: DataFrame, batch_id: int, cfg: RuleConfigA, scale: ScaleConfig = ScaleConfig()
) -> DataFrame | None:
    """Alerts of one batch, raised when its messages came in."""
    moving = batch_velocity(silver, batch_id, cfg, scale)
    if moving is None:
        return None
    alerts = rules.raise_alerts(moving, cfg, F.col("ingestion_timestamp"))
    return rules.alert_columns(alerts).withColumn("batch_id", F.lit(batch_id))


def velocity_handler(
    spark: SparkSession, state: str, output: str, cfg: RuleConfigA, scale: ScaleConfig = ScaleConfig()
) -> Callable[[DataFrame, int], None]:
    """Handler that stores typed transactions and their trailing velocity."""
    placed = ("transaction_date", "batch_id")

    def handle(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("batch_id", F.lit(batch_id))
        overwrite_partitions(marked, state, placed)
        stored = spark.read.schema(marked.schema).parquet(state)
        moving = batch_velocity(stored, batch_id, cfg, scale)
        if moving is not None:
            overwrite_partitions(moving, output, placed)

    return handle
