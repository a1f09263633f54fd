"""Streaming queries: run to the end of the input, then read the result back.

All available files form one micro-batch here; several ordered batches are
covered by the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...config import RuleConfigA
from ...operators import ingest as ingest_ops
from ...session import run_dir
from ...sources.messages import file_stream
from ...streaming import late, medallion, sinks, split, windows
from .. import alerting
from . import ingest, rules
from .base import Entry
from .inputs import SILVER_SQL, Inputs
from .velocity import _SLIDING_SQL

RULES = RuleConfigA()

_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


class StreamInputs(Inputs):
    """The same frames, with the events read as a stream."""

    def table(self, name: str) -> DataFrame:
        if name != "events":
            return super().table(name)
        return file_stream(self.spark, self.sf_dir, _EVENTS, file_filter="events.parquet")


def _collected(x: Inputs, stream: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Append the stream to a table in the shared folder and read the table."""
    base = run_dir(x.spark, label)
    sinks.finish(sinks.append_stream(stream, f"{base}/table", f"{base}/checkpoint", partition_by))
    return x.spark.read.schema(stream.schema).parquet(f"{base}/table")


def _typed(x: Inputs) -> DataFrame:
    s = StreamInputs(x.spark, x.sf_dir)
    return alerting.typed_amounts(s.bronze, x.dimensions)


def stream_bronze(x: Inputs) -> DataFrame:
    messages = StreamInputs(x.spark, x.sf_dir).messages
    parsed = ingest_ops.parse_messages(messages, ingested_at=F.lit(ingest.AS_OF))
    columns = [
        "transaction_id", "customer_id", "amount", "currency", "transaction_type", "channel",
        "transaction_timestamp", "kafka_partition", "kafka_offset", "kafka_timestamp", "ingestion_date",
    ]
    return _collected(x, parsed.select(*columns), "bronze", ("ingestion_date",))


def stream_silver(x: Inputs) -> DataFrame:
    s = StreamInputs(x.spark, x.sf_dir)
    silver = alerting.build_silver(s.bronze, x.dimensions, RULES).select(
        "transaction_id",
        "transaction_hour",
        "is_unusual_time",
        "business_day_flag",
        "is_high_value",
        "is_international",
        "transaction_date",
    )
    return _collected(x, silver, "silver", ("transaction_date",))


def stream_dedup(x: Inputs) -> DataFrame:
    """Every message delivered up to three times, kept once."""
    typed = _typed(x)
    copies = F.explode(F.sequence(F.lit(0), (F.col("amount") % 3).cast("int")))
    repeated = typed.withColumn("copy", copies).drop("copy")
    unique = windows.unique_transactions(repeated, spread=16).select("transaction_id", "customer_id", "amount_eur")
    return _collected(x, unique, "dedup")


DEDUP_SQL = f"WITH {SILVER_SQL}\nSELECT transaction_id, customer_id, amount_eur FROM sv"


def stream_window_agg(x: Inputs) -> DataFrame:
    """Windows whose end the watermark (newest event less two hours) has passed."""
    closed = windows.sliding_totals(_typed(x)).select(
        "customer_id",
        F.col("window.start").alias("window_start"),
        F.col("rolling_24h_amount").cast("decimal(38,2)").alias("rolling_24h_amount"),
        "rolling_24h_count",
    )
    return _collected(x, closed, "windows")


_CLOSED_SQL = f"""{_SLIDING_SQL},
closed AS (
  SELECT customer_id, window_start, rolling_24h_amount, rolling_24h_count FROM sliding
  WHERE window_start + INTERVAL 24 HOURS <= (SELECT date_trunc('milliseconds', max(transaction_timestamp)) - INTERVAL 2 HOURS FROM tx))"""
WINDOW_SQL = f"WITH {_CLOSED_SQL}\nSELECT * FROM closed"


def _some_without_customer(typed: DataFrame) -> DataFrame:
    """Every thirtieth or so transaction, by its number, comes without a customer."""
    number = F.substring("transaction_id", 4, 10).cast("int")
    return typed.withColumn("customer_id", F.when(number % 29 != 0, F.col("customer_id")))


def stream_window_join(x: Inputs) -> DataFrame:
    """Per transaction its windows, those with totals, and the largest of these; no transaction of a closed window is lost."""
    joined = windows.with_window_totals(_some_without_customer(_typed(x))).select(
        "transaction_id", F.col("window.start").alias("window_start"), "rolling_24h_amount", "rolling_24h_count"
    )
    rows = _collected(x, joined, "window-join")
    return rows.groupBy("transaction_id").agg(
        F.count("*").alias("windows"),
        F.count("rolling_24h_count").alias("windows_with_totals"),
        F.max("rolling_24h_amount").cast("decimal(38,2)").alias("peak_24h_amount"),
        F.max("rolling_24h_count").alias("peak_24h_count"),
    )


WINDOW_JOIN_SQL = f"""WITH {_CLOSED_SQL.replace("FROM sv CROSS", "FROM (SELECT * FROM sv WHERE CAST(substr(transaction_id, 4) AS INTEGER) % 29 <> 0) CROSS")},
ends AS (SELECT date_trunc('milliseconds', max(transaction_timestamp)) - INTERVAL 2 HOURS AS mark FROM tx),
placed AS (
  SELECT transaction_id, customer_id, date_trunc('hour', transaction_timestamp) - to_hours(CAST(k AS INTEGER)) AS window_start,
         CAST(substr(transaction_id, 4) AS INTEGER) % 29 = 0 AS lonely
  FROM sv, (SELECT unnest(range(0, 24)) AS k))
SELECT t.transaction_id, count(*) AS windows, count(c.rolling_24h_count) AS windows_with_totals,
       max(c.rolling_24h_amount) AS peak_24h_amount, max(c.rolling_24h_count) AS peak_24h_count
FROM placed t LEFT JOIN closed c ON c.customer_id = t.customer_id AND c.window_start = t.window_start AND NOT t.lonely, ends
WHERE t.window_start + INTERVAL 24 HOURS <= mark
GROUP BY t.transaction_id"""


# Every seventh transaction is held back until all others are through; the others come in two halves.
_HALF = "TIMESTAMP '2024-01-16'"


def stream_late_rows(x: Inputs) -> DataFrame:
    """Hourly totals of a stream in three batches, with how many of their rows came behind the watermark."""
    paths = late.LatePaths.under(run_dir(x.spark, "late"))
    handler = late.totals_handler(x.spark, paths)
    typed = alerting.typed_amounts(x.bronze, x.dimensions)
    held = F.substring("transaction_id", 4, 10).cast("int") % 7 == 0
    first = F.expr(f"transaction_timestamp < {_HALF}")
    for batch_id, part in enumerate((~held & first, ~held & ~first, held)):
        handler(typed.filter(part), batch_id)
    return late.totals(x.spark, paths).select("customer_id", "hour", "amount", "transactions", "late")


LATE_ROWS_SQL = f"""WITH {SILVER_SQL},
dealt AS (
  SELECT customer_id, transaction_timestamp AS ts, amount_eur,
         CASE WHEN CAST(substr(transaction_id, 4) AS INTEGER) % 7 = 0 THEN 2 WHEN transaction_timestamp < {_HALF} THEN 0 ELSE 1 END AS batch
  FROM sv),
marks AS (SELECT b.batch, max(d.ts) - INTERVAL 2 HOURS AS mark FROM (VALUES (1), (2)) AS b(batch) JOIN dealt d ON d.batch < b.batch GROUP BY b.batch)
SELECT customer_id, date_trunc('hour', ts) AS hour, CAST(sum(amount_eur) AS DECIMAL(38,2)) AS amount, count(*) AS transactions,
       count(*) FILTER (WHERE ts < mark) AS late
FROM dealt LEFT JOIN marks USING (batch) GROUP BY ALL"""


def stream_velocity(x: Inputs) -> DataFrame:
    """Trailing frame of every transaction, batch by batch over a stored state."""
    base = run_dir(x.spark, "velocity")
    narrow = _typed(x).select(
        "transaction_id", "customer_id", "transaction_timestamp", "transaction_date", "amount_eur"
    )
    handler = medallion.velocity_handler(x.spark, f"{base}/state", f"{base}/table", RULES)
    sinks.finish(sinks.each_batch(narrow, handler, f"{base}/checkpoint"))
    rows = x.spark.read.parquet(f"{base}/table")
    return rows.select("transaction_id", "customer_id", "rolling_24h_amount", "rolling_24h_count")


STREAM_VELOCITY_SQL = f"""WITH {SILVER_SQL}
SELECT transaction_id, customer_id, CAST(sum(amount_eur) OVER w AS DECIMAL(38,2)) AS rolling_24h_amount,
       count(*) OVER w AS rolling_24h_count FROM sv
WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_timestamp
             RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)"""


def stream_velocity_split(x: Inputs) -> DataFrame:
    """The same frame from state that is split by customer and hour, once the watermark has closed the hour."""
    settings = split.state_settings(x.spark)
    before = {key: x.spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            x.spark.conf.set(key, value)
        rows = _collected(x, split.split_velocity(_typed(x)), "velocity-split")
    finally:
        for key, value in before.items():
            x.spark.conf.set(key, value)
    return rows.select("transaction_id", "customer_id", "rolling_24h_amount", "rolling_24h_count")


SPLIT_VELOCITY_SQL = f"""{STREAM_VELOCITY_SQL}
QUALIFY date_trunc('hour', transaction_timestamp) + INTERVAL 1 HOUR
        <= (SELECT date_trunc('milliseconds', max(transaction_timestamp)) - INTERVAL 2 HOURS FROM tx)"""


def stream_alerts(x: Inputs) -> DataFrame:
    """Messages through quarantine, bronze and silver to the alert table."""
    base = run_dir(x.spark, "medallion")
    paths = medallion.MedallionPaths.under(base)
    parsed = ingest_ops.parse_messages(StreamInputs(x.spark, x.sf_dir).messages, ingested_at=F.col("kafka_timestamp"))
    handler = medallion.batch_handler(x.dimensions, RULES, paths)
    sinks.finish(sinks.each_batch(parsed, handler, f"{base}/checkpoint"))
    return x.spark.read.parquet(paths.alerts).select(
        "alert_id", "transaction_id", "customer_id", "rule_id", "risk_score", "alert_severity", "transaction_amount_eur"
    )


def stream_redelivery(x: Inputs) -> DataFrame:
    """Every third message comes again in a later batch, and once more in the same."""
    paths = medallion.MedallionPaths.under(run_dir(x.spark, "redelivery"))
    handler = medallion.batch_handler(x.dimensions, RULES, paths)
    parsed = ingest_ops.parse_messages(x.messages, ingested_at=F.col("kafka_timestamp"))
    again = parsed.filter("kafka_offset % 3 = 0")
    handler(parsed.unionByName(again), 0)
    handler(again, 1)
    return x.spark.read.parquet(paths.alerts).select(
        "alert_id", "transaction_id", "customer_id", "rule_id", "risk_score", "alert_severity", "transaction_amount_eur"
    )


# Broken messages go to quarantine before velocity is computed.
STREAM_ALERTS_SQL = "WITH " + rules.ALERTS_SQL.replace(
    "event_id % 101 <> 0 AND amount > 0", "event_id % 101 <> 0 AND event_id % 103 <> 0 AND amount > 0"
) + """
SELECT sha256(transaction_id || '|' || rule_id) AS alert_id, transaction_id, customer_id, rule_id, risk_score,
       alert_severity, amount_eur AS transaction_amount_eur FROM alerts"""


ENTRIES = {
    "stream_bronze": Entry(stream_bronze, ingest.PARSE_SQL),
    "stream_silver": Entry(stream_silver, ingest.FLAGS_SQL),
    "stream_dedup": Entry(stream_dedup, DEDUP_SQL),
    "stream_window_agg": Entry(stream_window_agg, WINDOW_SQL),
    "stream_window_join": Entry(stream_window_join, WINDOW_JOIN_SQL),
    "stream_late_rows": Entry(stream_late_rows, LATE_ROWS_SQL),
    "stream_velocity": Entry(stream_velocity, STREAM_VELOCITY_SQL),
    "stream_velocity_split": Entry(stream_velocity_split, SPLIT_VELOCITY_SQL),
    "stream_alerts": Entry(stream_alerts, STREAM_ALERTS_SQL),
    "stream_redelivery": Entry(stream_redelivery, STREAM_ALERTS_SQL),
}
