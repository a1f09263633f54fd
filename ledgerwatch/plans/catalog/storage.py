"""Jobs and tables: written to the shared folder, then read back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...config import JobConfig, QualityConfig, RuleConfigA
from ...operators import curve, digests, distinct
from ...operators import rules as rule_ops
from ...session import run_dir
from ...sources import maintenance, tables
from ...sources.messages import file_stream
from .. import jobs
from . import quality, reports, rules, streams
from .base import Entry
from .inputs import EVENTS_SQL, RAW_SQL, Inputs

AS_OF = datetime(2024, 1, 31)


ROWS_PER_FILE = 25_000  # text shrinks so much in a file that its bytes do not tell how long it takes to parse


def _slices(messages: DataFrame, slices: int) -> list[DataFrame]:
    """The messages by time, in order, dealt into files of even size; those without a time are in the last slice."""
    low, high = messages.agg(F.min("timestamp"), F.max("timestamp")).first()
    if low is None:
        return [messages]
    number = F.lit(slices - 1)
    for i in reversed(range(slices - 1)):
        number = F.when(F.col("timestamp") < F.lit(low + (high - low) * (i + 1) / slices), F.lit(i)).otherwise(number)
    counts = dict(messages.groupBy(number.alias("slice")).count().collect())
    return [messages.filter(number == i).repartition(-(-counts.get(i, 1) // ROWS_PER_FILE)) for i in range(slices)]


def _monitored(x: Inputs, slices: int = 4) -> str:
    """The streaming job, started again whenever a slice of the messages has come; each slice is one batch.

    A slice has files by its number of rows, so no slice is one task's work.
    """
    base, path = run_dir(x.spark, "monitoring"), run_dir(x.spark, "messages")
    for own in _slices(x.messages, slices):
        own.write.mode("append").parquet(path)
        stream = file_stream(x.spark, path, own.schema)
        jobs.run_monitoring(stream, lambda: x.dimensions, JobConfig(base, AS_OF), publish_format="json")
    return f"{base}/stream"


def monitoring_job(x: Inputs) -> DataFrame:
    """The streaming job over four slices of time: three queries at once, alerts stored."""
    return x.spark.read.parquet(f"{_monitored(x)}/alerts").select(
        "alert_id", "transaction_id", "customer_id", "rule_id", "risk_score", "alert_severity", "transaction_amount_eur"
    )


def monitoring_published(x: Inputs) -> DataFrame:
    """What the streaming job has published: alerts of the two upper severities."""
    published = x.spark.read.schema("key string, value string").json(f"{_monitored(x)}/published")
    return published.select(F.col("key").alias("customer_id"), F.get_json_object("value", "$.alert_id").alias("alert_id"))


PUBLISHED_SQL = f"SELECT customer_id, alert_id FROM ({streams.STREAM_ALERTS_SQL}) WHERE alert_severity IN ('CRITICAL', 'HIGH')"


def monitoring_progress(x: Inputs) -> DataFrame:
    """Rows that each query of the streaming job has reported, over all batches."""
    progress = x.spark.read.parquet(f"{_monitored(x)}/progress").filter(F.col("query_name").isin("raw", "enriched", "alerts"))
    return progress.groupBy("query_name").agg(F.sum("input_rows").alias("input_rows"))


PROGRESS_SQL = """
SELECT query_name, CAST(count(*) AS BIGINT) AS input_rows
FROM events, (VALUES ('raw'), ('enriched'), ('alerts')) q(query_name) GROUP BY query_name"""


def json_lines(x: Inputs) -> DataFrame:
    """Messages of the generator as JSON lines."""
    path = run_dir(x.spark, "json-lines")
    x.raw.select("transaction_id", "customer_id", "currency", F.col("amount").cast("double").alias("amount")).write.json(path)
    schema = T.StructType.fromDDL("transaction_id string, customer_id string, currency string, amount double")
    return tables.read_json_lines(x.spark, path, schema)


JSON_SQL = f"WITH {RAW_SQL}\nSELECT transaction_id, customer_id, currency, CAST(amount AS DOUBLE) AS amount FROM raw"


def appended_orders(x: Inputs) -> DataFrame:
    """Orders appended in two parts to a partitioned table and read by path."""
    path = run_dir(x.spark, "appended")
    orders = x.table("orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"))
    for part in (F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 2 != 0):
        tables.append_table(orders.filter(part), path, ("order_year",))
    return tables.read_table(x.spark, path)


def compacted_orders(x: Inputs) -> DataFrame:
    """The same table after its last two years were clustered into few files: no row differs."""
    path = run_dir(x.spark, "compacted")
    orders = x.table("orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"))
    tables.append_table(orders.repartition(8), path, ("order_year",))
    maintenance.compact(x.spark, path, ["o_custkey", "o_orderkey"], 2, ("order_year",), only={"order_year": [1997, 1998]})
    return tables.read_table(x.spark, path)


ORDERS_BY_YEAR_SQL = "SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders"


def _job(x: Inputs, as_of: datetime, label: str) -> JobConfig:
    return JobConfig(run_dir(x.spark, label), as_of, quality=QualityConfig(volume_min=1))


def weekly_job(x: Inputs) -> DataFrame:
    """The weekly job's summary as stored under its date."""
    cfg = _job(x, datetime(2024, 1, 20, 6), "weekly")
    tables.append_table(rules.enriched_b(x), cfg.path(*jobs.ENRICHED), ("processing_date",))
    return x.spark.read.parquet(jobs.weekly_analytics(x.spark, cfg)["weekly_summary"])


def fact_alert_load(x: Inputs) -> DataFrame:
    """The alert fact after the same day was loaded twice."""
    cfg = _job(x, datetime(2024, 2, 1, 6), "fact")
    alerts = rule_ops.pack_b_alerts(rules.enriched_b(x), F.lit(AS_OF))
    tables.append_table(alerts, cfg.path(*jobs.ALERTS))
    for _ in range(2):
        jobs.load_fact_alerts(x.spark, cfg)
    return tables.read_table(x.spark, cfg.path(*jobs.FACT_ALERTS)).select("transaction_id", "customer_id", "alert_priority", "alert_day")


FACT_LOAD_SQL = f"""WITH {rules.ENRICHED_B_SQL}
SELECT transaction_id, customer_id, alert_priority, DATE '2024-01-31' AS alert_day FROM enriched WHERE is_suspicious"""


def report_files(x: Inputs) -> DataFrame:
    """The alert summary from its dated folder, after the day's reports were written twice."""
    base = run_dir(x.spark, "reports")
    frames = {"alert_summary": reports.alert_summary(x), "rule_breakdown": reports.rule_breakdown(x)}
    for _ in range(2):
        tables.write_reports(frames, base, "report_date", AS_OF.date())
    return x.spark.read.option("basePath", base).parquet(f"{base}/report_date=*/alert_summary")


REPORT_FILES_SQL = f"SELECT *, DATE '2024-01-31' AS report_date FROM ({reports.SUMMARY_SQL})"


def quality_files(x: Inputs) -> DataFrame:
    """Details of a day's checks from their dated folder, beside their summary."""
    base = run_dir(x.spark, "quality")
    details = quality.quality_raw(x)
    frames = {"details": details, "summary": quality.ops.overall(details, quality.CFG)}
    tables.write_reports(frames, base, "check_date", AS_OF.date())
    stored = x.spark.read.option("basePath", base)
    passed = stored.parquet(f"{base}/check_date=*/summary").select("check_date", "overall_status")
    return stored.parquet(f"{base}/check_date=*/details").join(passed, "check_date")


QUALITY_FILES_SQL = f"""WITH {quality._DIRTY_SQL}
SELECT *, DATE '2024-01-31' AS check_date,
       (SELECT CASE WHEN count(*) FILTER (WHERE passed) * 100.0 / count(*) >= 95 THEN 'PASS' ELSE 'FAIL' END FROM raw_checks) AS overall_status
FROM raw_checks"""


def score_base_50(x: Inputs) -> DataFrame:
    """The alternative scoring: base 50, at most 100."""
    return rules.alerts(x, RuleConfigA(base_score=50, score_cap=100)).select("transaction_id", "risk_score")


BASE_50_SQL = f"WITH {rules.ALERTS_SQL}\nSELECT transaction_id, CAST(least(risk_score + 50, 100) AS DECIMAL(5,2)) AS risk_score FROM alerts"


def _on_curve(x: Inputs) -> DataFrame:
    """Orders in files along a curve of customer, date and price."""
    path, laid_out = run_dir(x.spark, "orders"), run_dir(x.spark, "orders-on-curve")
    orders = x.table("orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    tables.append_table(orders, path)
    maintenance.compact(x.spark, path, ["o_custkey", "o_orderdate", "o_totalprice"], 64, target=laid_out, curve_bits=8)
    return tables.read_table(x.spark, laid_out)


def curve_orders(x: Inputs) -> DataFrame:
    """Every order after its table was laid along the curve: no row differs."""
    return _on_curve(x)


CURVE_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"""

SPANS = [
    curve.Span("customer", "o_custkey", 0, 2),
    curve.Span("date", "o_orderdate", date(1997, 3, 1), date(1997, 3, 31)),
    curve.Span("price", "o_totalprice", 100_000.0, 110_000.0),
]


def curve_pruning(x: Inputs) -> DataFrame:
    """For a narrow span of each column alone: its rows, and whether most files need not be opened for it."""
    touched = curve.files_touched(_on_curve(x), SPANS)
    return touched.select("span", "rows_found", (F.col("files_touched") * 2 <= F.col("files")).alias("most_files_skipped"))


PRUNING_SQL = """
SELECT 'customer' AS span, count(*) FILTER (WHERE o_custkey BETWEEN 0 AND 2) AS rows_found, TRUE AS most_files_skipped FROM orders
UNION ALL
SELECT 'date', count(*) FILTER (WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'), TRUE FROM orders
UNION ALL
SELECT 'price', count(*) FILTER (WHERE o_totalprice BETWEEN 100000 AND 110000), TRUE FROM orders"""


def _member_table(x: Inputs) -> DataFrame:
    """Daily customer bitmaps by type, loaded in two parts; the second adds its customers to the numbering."""
    base = run_dir(x.spark, "members")
    raw = x.raw.select("customer_id", "transaction_type", F.to_date("transaction_timestamp").alias("day"))
    known = None
    for i, part in enumerate((F.col("day") < "2024-01-16", F.col("day") >= "2024-01-16")):
        load = raw.filter(part)
        distinct.number_keys(load, "customer_id", known).write.parquet(f"{base}/keys-{i}")
        known = x.spark.read.parquet(f"{base}/keys-{i}")
        daily = distinct.members(load.join(known, "customer_id"), "key_number", ["transaction_type", "day"])
        tables.append_table(daily, f"{base}/daily")
    return tables.read_table(x.spark, f"{base}/daily")


def distinct_by_month(x: Inputs) -> DataFrame:
    """Distinct customers of each month and type, merged from daily bitmaps."""
    monthly = _member_table(x).withColumn("month", F.trunc("day", "month"))
    return distinct.count_members(monthly, ["month", "transaction_type"])


MONTH_SQL = f"""WITH {RAW_SQL}
SELECT CAST(date_trunc('month', transaction_timestamp) AS DATE) AS month, transaction_type, count(DISTINCT customer_id) AS n_distinct
FROM raw GROUP BY ALL"""


def distinct_rolling_week(x: Inputs) -> DataFrame:
    """Distinct customers of the seven days up to each day, of all types together."""
    return distinct.rolling_distinct(_member_table(x), "day", 7)


WEEK_SQL = f"""WITH {RAW_SQL}, d AS (SELECT DISTINCT CAST(transaction_timestamp AS DATE) AS d, customer_id FROM raw)
SELECT CAST(d + CAST(k AS INTEGER) AS DATE) AS day, count(DISTINCT customer_id) AS n_distinct
FROM d, range(7) r(k) WHERE d + CAST(k AS INTEGER) <= (SELECT max(d) FROM d) GROUP BY ALL"""


def reconciled_by_digest(x: Inputs) -> DataFrame:
    """Keys that differ between the events and a copy with rows lost, changed, moved, repeated and added."""
    path = run_dir(x.spark, "events-copy")
    events = x.events.withColumn("day", F.to_date("ts"))
    n = F.col("event_id")
    copy = (
        events.filter(n % 997 != 5)
        .withColumn("amount", F.when(n % 991 == 7, -F.col("amount")).otherwise(F.col("amount")))
        .withColumn("event_type", F.when(n % 983 != 11, F.col("event_type")))
        .withColumn("day", F.when(n % 977 == 13, F.date_add("day", 1)).otherwise(F.col("day")))
    )
    extra = events.filter(n % 971 == 17)
    added = events.filter(n % 967 == 19).withColumn("event_id", -n)
    tables.append_table(copy.unionByName(extra).unionByName(added), path, ("day",))
    changed = tables.read_table(x.spark, path).select(*events.columns)
    return digests.reconcile_tables(events, changed, ["event_id"], "day")


DIGEST_SQL = f"""WITH {EVENTS_SQL},
copies AS (
  SELECT event_id, event_id % 997 = 5 AS lost, event_id % 971 = 17 AS repeated,
         event_id % 991 = 7 OR event_id % 983 = 11 OR event_id % 977 = 13 AS altered
  FROM ev)
SELECT event_id, CASE WHEN lost AND NOT repeated THEN 'missing' ELSE 'changed' END AS status, CAST(1 AS BIGINT) AS rows_left,
       CAST(NOT lost AS BIGINT) + CAST(repeated AS BIGINT) AS rows_right
FROM copies WHERE lost <> repeated OR altered AND NOT lost
UNION ALL
SELECT -event_id, 'unexpected', 0, 1 FROM ev WHERE event_id % 967 = 19"""


ENTRIES = {
    "monitoring_job": Entry(monitoring_job, streams.STREAM_ALERTS_SQL),
    "monitoring_published": Entry(monitoring_published, PUBLISHED_SQL),
    "monitoring_progress": Entry(monitoring_progress, PROGRESS_SQL),
    "json_lines": Entry(json_lines, JSON_SQL),
    "appended_orders": Entry(appended_orders, ORDERS_BY_YEAR_SQL),
    "compacted_orders": Entry(compacted_orders, ORDERS_BY_YEAR_SQL),
    "curve_orders": Entry(curve_orders, CURVE_SQL),
    "curve_pruning": Entry(curve_pruning, PRUNING_SQL),
    "distinct_by_month": Entry(distinct_by_month, MONTH_SQL),
    "distinct_rolling_week": Entry(distinct_rolling_week, WEEK_SQL),
    "reconciled_by_digest": Entry(reconciled_by_digest, DIGEST_SQL),
    "weekly_job": Entry(weekly_job, reports.WEEKLY_SQL),
    "fact_alert_load": Entry(fact_alert_load, FACT_LOAD_SQL),
    "report_files": Entry(report_files, REPORT_FILES_SQL),
    "quality_files": Entry(quality_files, QUALITY_FILES_SQL),
    "score_base_50": Entry(score_base_50, BASE_50_SQL),
}
