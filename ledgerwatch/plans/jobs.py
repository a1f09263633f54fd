"""Scheduled batch jobs over the stored tables of one ``JobConfig``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..operators import ingest, merge, profiles, quality, reports, rules
from ..sources.snapshots import SnapshotTable, upsert_partitions
from ..sources.tables import create_if_missing, dated_path, overwrite_partitions, read_table, write_reports
from ..streaming import medallion, sinks
from ..streaming.progress import ProgressLog
from . import alerting

SILVER = ("silver", "transactions")
PROFILES = ("gold", "customer_profiles")
CUSTOMER_DIM = ("gold", "dim_customer")
ALERTS = ("gold", "alerts")
ENRICHED = ("data", "enriched_transactions")
RAW = ("data", "raw_transactions")
REPORTS = ("reports",)
QUALITY = ("quality",)
ANALYTICS = ("analytics",)
FACT_ALERTS = ("warehouse", "fact_alerts")


def _read(spark: SparkSession, job: JobConfig, table: tuple[str, ...]) -> DataFrame:
    return read_table(spark, job.path(*table), job.table_format)


def on_day(df: DataFrame, column: str, day: date) -> DataFrame:
    """Rows whose timestamp falls on ``day``, as a range that can be pushed down."""
    start = datetime.combine(day, time())
    return df.filter((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(start + timedelta(days=1))))


def refresh_profiles(spark: SparkSession, job: JobConfig, customer_master: DataFrame) -> DataFrame:
    """Daily profiles, and a new dimension version for every changed risk category.

    Returns the sanity counters of the stored profiles.
    """
    computed = profiles.customer_profiles(_read(spark, job, SILVER), job.run_date, job.profile)
    stamped = profiles.stamp_profiles(computed, job.run_date, F.lit(job.as_of))
    overwrite_partitions(stamped, job.path(*PROFILES), ("effective_date",))
    stored = _read(spark, job, PROFILES).filter(F.col("effective_date") == F.lit(job.run_date))

    named = stored.join(customer_master.select("customer_id", "customer_name"), "customer_id", "left")
    incoming = named.select(
        "customer_id",
        "customer_name",
        "risk_category",
        "avg_transaction_amount_90d",
        "avg_transaction_amount_30d",
        "transaction_count_30d",
        "transaction_count_90d",
        "last_transaction_date",
    )
    dimension = SnapshotTable(spark, job.path(*CUSTOMER_DIM))
    if dimension.exists():
        updated = merge.scd2_risk_category(dimension.read(), incoming, job.run_date)
    else:
        updated = incoming.withColumns(
            {
                "effective_date": F.lit(job.run_date),
                "expiration_date": F.lit(merge.FAR_FUTURE),
                "is_current": F.lit(True),
            }
        )
    dimension.commit(updated, job.as_of, "SCD2")
    return quality.profile_sanity(stored)


def daily_report(spark: SparkSession, job: JobConfig, customers: DataFrame) -> dict[str, str]:
    """The six report frames of one day; empty when the day had no alerts.

    The enriched alerts are written first and the reports read them back, so
    the joins run once and a lost executor does not repeat them.
    """
    alerts = on_day(_read(spark, job, ALERTS), "alert_generated_at", job.run_date)
    if not quality.has_at_least(alerts, 1):
        return {}
    transactions = _read(spark, job, ENRICHED).filter(F.col("processing_date") == F.lit(job.run_date))
    base = job.path(*REPORTS)
    details = reports.enrich_alerts(alerts, transactions, customers)
    paths = write_reports({"alert_details": details}, base, "report_date", job.run_date)
    stored = spark.read.parquet(paths["alert_details"])
    frames = {
        "summary": reports.alert_summary(stored),
        "rule_breakdown": reports.rule_breakdown(stored),
        "customer_risk": reports.customer_risk(stored),
        "customer_flagged_transactions": reports.customer_flagged_transactions(stored),
        "geographic_analysis": reports.geographic(stored),
        "compliance_metrics": reports.compliance_kpis(stored, job.run_date, F.lit(job.as_of)),
    }
    return paths | write_reports(frames, base, "report_date", job.run_date)


def check_quality(spark: SparkSession, job: JobConfig, customer_profiles: DataFrame) -> DataFrame:
    """Three suites, stored as details and summary; returns the summary."""
    today = F.col("processing_date") == F.lit(job.run_date)
    stamp = F.lit(job.as_of)
    details = (
        quality.raw_suite(_read(spark, job, RAW).filter(today), job.quality)
        .unionByName(quality.enriched_suite(_read(spark, job, ENRICHED).filter(today)))
        .unionByName(quality.profile_suite(customer_profiles.filter("is_current"), stamp, job.quality))
        .withColumns({"check_date": F.lit(job.run_date), "check_timestamp": stamp})
    )
    base = job.path(*QUALITY)
    paths = write_reports({"details": details}, base, "check_date", job.run_date)
    summary = quality.overall(spark.read.parquet(paths["details"]), job.quality).withColumns(
        {"check_date": F.lit(job.run_date), "check_timestamp": stamp}
    )
    paths |= write_reports({"summary": summary}, base, "check_date", job.run_date)
    return spark.read.parquet(paths["summary"])


def weekly_analytics(spark: SparkSession, job: JobConfig) -> dict[str, str]:
    week = reports.in_week(_read(spark, job, ENRICHED), job.run_date)
    base = job.path(*ANALYTICS)
    paths = {
        "weekly_summary": dated_path(f"{base}/weekly_summary", "week_ending", job.run_date),
        "customer_trends": dated_path(f"{base}/customer_trends", "week_ending", job.run_date),
    }
    reports.weekly_summary(week).write.mode("overwrite").parquet(paths["weekly_summary"])
    reports.weekly_trends(week).write.mode("overwrite").parquet(paths["customer_trends"])
    return paths


def load_fact_alerts(spark: SparkSession, job: JobConfig) -> None:
    """Merge the previous day's alerts into the alert fact; only that day's partition is rewritten.

    The fact is partitioned by ``alert_day``, which an alert keeps, so the daily
    cost is that of a day, not of the table.
    """
    yesterday = job.run_date - timedelta(days=1)
    staged = on_day(_read(spark, job, ALERTS), "alert_generated_at", yesterday).withColumn("alert_day", F.lit(yesterday))
    path = job.path(*FACT_ALERTS)
    create_if_missing(spark, path, staged.schema, ("alert_day",))
    upsert_partitions(spark, path, staged, ["transaction_id"], "alert_day", schema=staged.schema)


def run_monitoring(
    messages: DataFrame,
    dims: Callable[[], alerting.Dimensions],
    job: JobConfig,
    every: str | None = None,
    routed: tuple[str, ...] = ("CRITICAL", "HIGH"),
    publish_format: str = "kafka",
    publish_options: dict[str, str] | None = None,
) -> None:
    """The streaming job: raw messages (broker columns) to bronze, silver and routed alerts.

    Three queries run at once over the same source, each with its own checkpoint: the
    bronze and silver tables by append, alerts by micro-batch (``every`` names the
    trigger interval; without it all that is there is processed once). Alerts of the
    ``routed`` severities are published as key and JSON in the batch that stores
    them, at least once. Progress of all queries goes to a table, batch by batch.
    """
    spark = messages.sparkSession
    parsed = ingest.parse_messages(messages, ingested_at=F.col("kafka_timestamp"))
    base = job.path("stream")
    publish_options = publish_options or {}

    def publish(alerts: DataFrame, batch_id: int) -> None:
        writer = rules.route_alerts(alerts, routed).write.format(publish_format).options(**publish_options)
        if publish_format == "kafka":
            writer.save()
        else:  # a folder for each batch, so that a repeated batch replaces its own
            writer.mode("overwrite").save(f"{base}/published/batch={batch_id}")

    log = ProgressLog()
    spark.streams.addListener(log)
    accepted = ingest.split_quarantine(ingest.contract_violations(parsed))[0]
    silver = alerting.build_silver(accepted, dims(), job.rules_a)
    stored = medallion.batch_handler(dims, job.rules_a, medallion.MedallionPaths.under(base), job.scale, publish)

    def handler(batch: DataFrame, batch_id: int) -> None:
        stored(batch, batch_id)
        log.append_to(spark, f"{base}/progress")  # so that reports neither pile up on the driver nor are lost with it

    queries = [
        sinks.append_stream(parsed, f"{base}/raw", f"{base}/checkpoints/raw", ("ingestion_date",), every=every, name="raw"),
        sinks.append_stream(silver, f"{base}/enriched", f"{base}/checkpoints/enriched", ("transaction_date",), every=every, name="enriched"),
        sinks.each_batch(parsed, handler, f"{base}/checkpoints/alerts", every=every, name="alerts"),
    ]
    try:
        if every is None:
            for query in queries:
                sinks.finish(query)
        else:
            sinks.run_until_stopped(spark, queries)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(log)
        log.append_to(spark, f"{base}/progress")

