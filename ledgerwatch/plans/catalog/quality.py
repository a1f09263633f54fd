"""Data-quality suites and service checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...config import QualityConfig
from ...operators import columns
from ...operators import quality as ops
from ...session import run_dir
from ...sources import tables
from .. import alerting
from . import profiles, rules
from .base import Entry
from .inputs import EVENTS_SQL, RAW_SQL, Inputs
from .profiles import _PROFILE_SQL, EXTENDED_PROFILE_SQL

AS_OF = datetime(2024, 1, 31)
CFG = QualityConfig()


def dirty_raw(x: Inputs) -> DataFrame:
    """Raw transactions with missing, negative, repeated and unknown values."""
    n = "CAST(substring(transaction_id, 4, 10) AS BIGINT)"
    return x.raw.selectExpr(
        f"CASE WHEN {n} % 71 = 0 THEN NULL WHEN {n} % 73 = 0 THEN 'TXN0000000001' ELSE transaction_id END AS transaction_id",
        "customer_id",
        f"CASE WHEN {n} % 97 = 0 THEN NULL WHEN {n} % 89 = 0 THEN -amount ELSE amount END AS amount",
        "currency",
        "transaction_type",
        f"CASE WHEN {n} % 101 <> 0 THEN CAST(transaction_timestamp AS STRING) END AS timestamp",
        "transaction_timestamp",
        f"CASE WHEN {n} % 103 = 0 THEN transaction_timestamp - INTERVAL 1 HOUR ELSE processing_timestamp END AS processing_timestamp",
    )


_DIRTY_SQL = f"""{RAW_SQL},
dirty AS (
  SELECT CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 73 = 0 THEN 'TXN0000000001' ELSE transaction_id END AS transaction_id,
         customer_id, CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -amount ELSE amount END AS amount,
         currency, transaction_type, event_id % 101 <> 0 AS has_time, transaction_timestamp,
         CASE WHEN event_id % 103 = 0 THEN transaction_timestamp - INTERVAL 1 HOUR ELSE processing_timestamp END AS processing_timestamp
  FROM raw),
m AS (
  SELECT CAST(count(*) AS DOUBLE) AS n,
    CAST(count(*) FILTER (WHERE transaction_id IS NULL) AS DOUBLE) AS no_id,
    CAST(count(*) FILTER (WHERE amount IS NULL) AS DOUBLE) AS no_amount,
    CAST(count(*) FILTER (WHERE NOT has_time) AS DOUBLE) AS no_time,
    CAST(count(*) FILTER (WHERE currency NOT IN ('EUR','USD','GBP','CHF','AED','RUB','CNY','TRY')) AS DOUBLE) AS bad_currency,
    CAST(count(*) FILTER (WHERE amount <= 0) AS DOUBLE) AS bad_amount,
    CAST(count(*) - count(DISTINCT transaction_id) - 1 AS DOUBLE) AS repeated,
    CAST(count(*) FILTER (WHERE transaction_timestamp > processing_timestamp) AS DOUBLE) AS too_late
  FROM dirty),
raw_checks(table_name, check_type, check_name, metric_value, metric_percent, passed) AS (
  SELECT 'raw_transactions', 'COMPLETENESS', 'transaction_id', no_id, round(no_id * 100 / n, 2), no_id = 0 FROM m UNION ALL
  SELECT 'raw_transactions', 'COMPLETENESS', 'customer_id', 0, 0, TRUE FROM m UNION ALL
  SELECT 'raw_transactions', 'COMPLETENESS', 'amount', no_amount, round(no_amount * 100 / n, 2), no_amount = 0 FROM m UNION ALL
  SELECT 'raw_transactions', 'COMPLETENESS', 'currency', 0, 0, TRUE FROM m UNION ALL
  SELECT 'raw_transactions', 'COMPLETENESS', 'timestamp', no_time, round(no_time * 100 / n, 2), no_time = 0 FROM m UNION ALL
  SELECT 'raw_transactions', 'VALIDITY', 'valid_currency', bad_currency, round(bad_currency * 100 / n, 2), bad_currency = 0 FROM m UNION ALL
  SELECT 'raw_transactions', 'VALIDITY', 'valid_transaction_type', 0, 0, TRUE FROM m UNION ALL
  SELECT 'raw_transactions', 'VALIDITY', 'positive_amount', bad_amount, round(bad_amount * 100 / n, 2), bad_amount = 0 FROM m UNION ALL
  SELECT 'raw_transactions', 'UNIQUENESS', 'transaction_id', repeated, NULL, repeated = 0 FROM m UNION ALL
  SELECT 'raw_transactions', 'CONSISTENCY', 'transaction_timestamp_before_processing', too_late, NULL, too_late = 0 FROM m UNION ALL
  SELECT 'raw_transactions', 'CONSISTENCY', 'positive_amounts', bad_amount, NULL, bad_amount = 0 FROM m UNION ALL
  SELECT 'raw_transactions', 'VOLUME', 'row_count', n, NULL, n BETWEEN 1000000 AND 10000000 FROM m)"""


def quality_raw(x: Inputs) -> DataFrame:
    return ops.raw_suite(dirty_raw(x), CFG)


def _only(check_type: str):
    def build(x: Inputs) -> DataFrame:
        return quality_raw(x).filter(F.col("check_type") == check_type)

    return Entry(build, f"WITH {_DIRTY_SQL}\nSELECT * FROM raw_checks WHERE check_type = '{check_type}'")


def quality_enriched(x: Inputs) -> DataFrame:
    return ops.enriched_suite(rules.enriched_b(x))


ENRICHED_SQL = f"""WITH {rules.ENRICHED_B_SQL},
names(check_type, check_name, rated) AS (VALUES
  ('COMPLETENESS', 'transaction_id', TRUE), ('COMPLETENESS', 'customer_id', TRUE), ('COMPLETENESS', 'amount', TRUE),
  ('COMPLETENESS', 'transaction_risk_score', TRUE), ('COMPLETENESS', 'is_suspicious', TRUE),
  ('VALIDITY', 'risk_score_range', TRUE), ('VALIDITY', 'valid_priority', TRUE), ('VALIDITY', 'positive_rules', TRUE),
  ('CONSISTENCY', 'transaction_timestamp_before_processing', FALSE), ('CONSISTENCY', 'positive_amounts', FALSE)),
bad AS (SELECT CAST(count(*) FILTER (WHERE amount <= 0) AS DOUBLE) AS negative FROM enriched)
SELECT 'enriched_transactions' AS table_name, check_type, check_name,
       CASE WHEN check_name = 'positive_amounts' THEN negative ELSE 0 END AS metric_value,
       CASE WHEN rated THEN CAST(0 AS DOUBLE) END AS metric_percent,
       check_name <> 'positive_amounts' OR negative = 0 AS passed
FROM names CROSS JOIN bad"""


def _current_profiles(x: Inputs) -> DataFrame:
    return profiles.extended(x).withColumn("profile_timestamp", F.col("last_transaction_date"))


def quality_profiles(x: Inputs) -> DataFrame:
    return ops.profile_suite(_current_profiles(x), F.lit(AS_OF), CFG)


PROFILE_SQL = f"""WITH {EXTENDED_PROFILE_SQL},
m AS (SELECT count(*) AS n, count(*) - count(DISTINCT customer_id) AS repeated,
             (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(last_transaction_date))) / CAST(3.6e9 AS DOUBLE) AS lag
      FROM extended_profiles),
names(check_type, check_name) AS (VALUES
  ('COMPLETENESS', 'customer_id'), ('COMPLETENESS', 'risk_score'), ('COMPLETENESS', 'risk_category'),
  ('VALIDITY', 'risk_score_range'), ('VALIDITY', 'valid_risk_category'), ('VALIDITY', 'valid_kyc'))
SELECT 'customer_profiles' AS table_name, check_type, check_name, CAST(0 AS DOUBLE) AS metric_value,
       CAST(0 AS DOUBLE) AS metric_percent, TRUE AS passed FROM names UNION ALL
SELECT 'customer_profiles', 'UNIQUENESS', 'customer_id', repeated, NULL, repeated = 0 FROM m UNION ALL
SELECT 'customer_profiles', 'TIMELINESS', 'data_freshness', round(lag, 2), NULL, lag < 24 FROM m"""


def dq_overall(x: Inputs) -> DataFrame:
    return ops.overall(quality_raw(x), CFG)


OVERALL_SQL = f"""WITH {_DIRTY_SQL}
SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks,
       count(*) FILTER (WHERE NOT passed) AS failed_checks,
       round(count(*) FILTER (WHERE passed) * CAST(100 AS DOUBLE) / count(*), 2) AS quality_score,
       CASE WHEN count(*) FILTER (WHERE passed) * CAST(100 AS DOUBLE) / count(*) >= 95 THEN 'PASS' ELSE 'FAIL' END AS overall_status
FROM raw_checks"""


def completeness_score(x: Inputs) -> DataFrame:
    return ops.completeness_score(dirty_raw(x), ["transaction_id", "amount", "timestamp"])


SCORE_SQL = f"""WITH {_DIRTY_SQL},
c AS (SELECT count(*) AS total_rows,
             count(*) FILTER (WHERE transaction_id IS NOT NULL AND amount IS NOT NULL AND has_time) AS complete_rows FROM dirty)
SELECT *, CAST(complete_rows AS DOUBLE) / CAST(total_rows AS DOUBLE) AS completeness FROM c"""


def profile_sanity(x: Inputs) -> DataFrame:
    return ops.profile_sanity(profiles._profiles(x))


SANITY_SQL = f"""WITH {_PROFILE_SQL}
SELECT count(*) FILTER (WHERE risk_category IS NULL) AS null_category_count,
       count(*) FILTER (WHERE transaction_count_90d <= 0) AS invalid_count_count,
       count(*) FILTER (WHERE avg_transaction_amount_90d < 0 OR avg_transaction_amount_90d > 1000000) AS suspicious_average_count
FROM profiles"""


def referential_integrity(x: Inputs) -> DataFrame:
    return ops.referential_integrity(x.raw, x.customers, "customer_id")


INTEGRITY_SQL = f"""WITH {EVENTS_SQL}
SELECT count(DISTINCT customer_id) AS orphan_keys, count(*) AS orphan_rows FROM ev
WHERE user_id NOT IN (SELECT c_custkey FROM customer)"""


def reconciliation(x: Inputs) -> DataFrame:
    """Raw layer against the accepted, typed layer, per currency."""
    typed = alerting.typed_amounts(x.bronze, x.dimensions)
    return ops.reconcile(x.raw, typed, ["currency"], "amount")


RECONCILE_SQL = f"""WITH {RAW_SQL},
l AS (SELECT currency, count(*) AS left_rows, CAST(sum(amount) AS DECIMAL(38,2)) AS left_amount FROM raw GROUP BY 1),
r AS (SELECT currency, count(*) AS right_rows, CAST(sum(amount) AS DECIMAL(38,2)) AS right_amount FROM raw
      WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 101 <> 0 AND amount > 0 GROUP BY 1)
SELECT currency, left_rows, left_amount, right_rows, right_amount, left_rows - right_rows AS row_difference,
       CAST(left_amount - right_amount AS DECIMAL(38,2)) AS amount_difference,
       left_rows = right_rows AND left_amount = right_amount AS reconciled
FROM l FULL JOIN r USING (currency)"""


def sla_latency(x: Inputs) -> DataFrame:
    """Event to ingestion time; the 95th percentile is an observed value."""
    return ops.service_levels(x.bronze.withColumn("seen", F.to_timestamp(F.expr(
        "CASE WHEN transaction_timestamp <> 'not a time' THEN transaction_timestamp END"))),
        "seen", "ingestion_timestamp", F.lit(AS_OF), CFG, quality_score=99.5)


SLA_SQL = f"""WITH {EVENTS_SQL},
p AS (SELECT quantile_disc((event_id % 5), 0.95) FILTER (WHERE event_id % 101 <> 0) AS p95,
             (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts + to_seconds(event_id % 5)))) / CAST(6e7 AS DOUBLE) AS lag_minutes
      FROM ev)
SELECT CAST(p95 AS DOUBLE) AS p95_latency_seconds, lag_minutes, p95 < 3 AS latency_ok, lag_minutes <= 5 AS lag_ok, TRUE AS quality_ok FROM p"""


def column_statistics(x: Inputs) -> DataFrame:
    stats = ops.column_statistics(x.table("lineitem"), ["l_quantity", "l_discount", "l_extendedprice"])
    return stats.withColumn("mean", F.round("mean", 6))


STATISTICS_SQL = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS filled, count(*) - count({c}) AS nulls, min({c}) AS minimum, "
    f"max({c}) AS maximum, round(avg({c}), 6) AS mean FROM lineitem"
    for c in ("l_quantity", "l_discount", "l_extendedprice")
)


def table_health(x: Inputs) -> DataFrame:
    """Two readable tables and one that does not exist."""
    paths = {
        "orders": f"{x.sf_dir}/orders.parquet",
        "events": f"{x.sf_dir}/events.parquet",
        "missing": f"{run_dir(x.spark, 'health')}/missing",
    }
    return tables.table_health(x.spark, paths)


HEALTH_SQL = """SELECT 'orders' AS table_name, count(*) AS row_count, 'GOOD' AS health, NULL AS error FROM orders
UNION ALL SELECT 'events', count(*), 'GOOD', NULL FROM events
UNION ALL SELECT 'missing', NULL, 'BAD', 'PATH_NOT_FOUND'"""


PROFILED = ["transaction_id", "customer_id", "amount", "timestamp", "transaction_timestamp"]


def column_profiles(x: Inputs) -> DataFrame:
    """All days' profiles of the dirty transactions, merged; and whether their estimates keep their bounds."""
    path = run_dir(x.spark, "profiles")
    dirty = dirty_raw(x).select(*PROFILED)
    columns.profile(dirty.withColumn("day", F.to_date("transaction_timestamp")), ["day"]).write.parquet(path)
    merged = columns.described(columns.merge_profiles(x.spark.read.parquet(path), []), (0.5,))
    exact = dirty.agg(*[F.count_distinct(c).alias(c) for c in PROFILED])
    exact = exact.unpivot([], PROFILED, "column_name", "exact_distinct")
    median = F.col("quantiles")[0]
    ranks = dirty.select(*[columns.number_of(dirty, c).alias(c) for c in PROFILED]).unpivot([], PROFILED, "column_name", "v")
    ranks = ranks.filter("v IS NOT NULL").join(merged.select("column_name", median.alias("median")), "column_name")
    placed = ranks.groupBy("column_name").agg(
        (F.count_if(F.col("v") < F.col("median")) / F.count("*")).alias("below"),
        (F.count_if(F.col("v") <= F.col("median")) / F.count("*")).alias("up_to"),
    )
    return merged.join(exact, "column_name").join(placed, "column_name").select(
        "column_name",
        "n_rows",
        "nulls",
        "exact_distinct",
        (F.abs(F.col("n_distinct") - F.col("exact_distinct")) <= 0.08 * F.col("exact_distinct")).alias("distinct_close"),
        ((F.col("below") <= 0.52) & (F.col("up_to") >= 0.48)).alias("median_close"),
    )


COLUMN_PROFILES_SQL = f"""WITH {_DIRTY_SQL},
named(column_name, value) AS (
  SELECT 'transaction_id', transaction_id FROM dirty UNION ALL SELECT 'customer_id', customer_id FROM dirty UNION ALL
  SELECT 'amount', CAST(amount AS VARCHAR) FROM dirty UNION ALL
  SELECT 'timestamp', CASE WHEN has_time THEN CAST(transaction_timestamp AS VARCHAR) END FROM dirty UNION ALL
  SELECT 'transaction_timestamp', CAST(transaction_timestamp AS VARCHAR) FROM dirty)
SELECT column_name, count(*) AS n_rows, count(*) - count(value) AS nulls, count(DISTINCT value) AS exact_distinct,
       TRUE AS distinct_close, TRUE AS median_close
FROM named GROUP BY column_name"""


def column_drift(x: Inputs) -> DataFrame:
    """Columns of the events that moved from the first half of the month to the second, in which amounts are doubled."""
    late = F.col("ts") >= "2024-01-16"
    amount = F.when(late, F.col("amount") * 2).otherwise(F.col("amount"))
    kind = F.when(~late | (F.col("event_id") % 2 == 0), F.col("event_type"))
    events = x.events.select("event_id", "user_id", amount.alias("amount"), kind.alias("event_type"), late.alias("late"))
    profiles = columns.profile(events, ["late"])
    return columns.drift(profiles.filter("NOT late"), profiles.filter("late"), 0.2).select("column_name", "drifted")


# Exact distances; half of the types are missing in the second half.
DRIFT_SQL = f"""WITH {EVENTS_SQL},
named AS (
  SELECT ts >= TIMESTAMP '2024-01-16' AS late, UNNEST([
    {{'c': 'event_id', 'v': CAST(event_id AS DOUBLE)}}, {{'c': 'user_id', 'v': CAST(user_id AS DOUBLE)}},
    {{'c': 'amount', 'v': CAST(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN amount * 2 ELSE amount END AS DOUBLE)}}]) AS f FROM ev),
per_value AS (SELECT f.c AS c, f.v AS v, count(*) FILTER (WHERE NOT late) AS a, count(*) FILTER (WHERE late) AS b FROM named GROUP BY 1, 2),
running AS (SELECT c, sum(a) OVER w / sum(a) OVER (PARTITION BY c) - sum(b) OVER w / sum(b) OVER (PARTITION BY c) AS gap
            FROM per_value WINDOW w AS (PARTITION BY c ORDER BY v))
SELECT c AS column_name, max(abs(gap)) > 0.2 AS drifted FROM running GROUP BY c
UNION ALL SELECT 'event_type', count(*) FILTER (WHERE event_id % 2 <> 0) / count(*) > 0.2 FROM ev WHERE ts >= TIMESTAMP '2024-01-16'"""


ENTRIES = {
    "column_profiles": Entry(column_profiles, COLUMN_PROFILES_SQL),
    "column_drift": Entry(column_drift, DRIFT_SQL),
    "quality_raw": Entry(quality_raw, f"WITH {_DIRTY_SQL}\nSELECT * FROM raw_checks"),
    "completeness": _only("COMPLETENESS"),
    "validity": _only("VALIDITY"),
    "consistency": _only("CONSISTENCY"),
    "uniqueness": _only("UNIQUENESS"),
    "volume": _only("VOLUME"),
    "quality_enriched": Entry(quality_enriched, ENRICHED_SQL),
    "quality_profiles": Entry(quality_profiles, PROFILE_SQL),
    "dq_overall": Entry(dq_overall, OVERALL_SQL),
    "completeness_score": Entry(completeness_score, SCORE_SQL),
    "profile_sanity": Entry(profile_sanity, SANITY_SQL),
    "referential_integrity": Entry(referential_integrity, INTEGRITY_SQL),
    "reconciliation": Entry(reconciliation, RECONCILE_SQL),
    "sla_latency": Entry(sla_latency, SLA_SQL),
    "column_statistics": Entry(column_statistics, STATISTICS_SQL),
    "table_health": Entry(table_health, HEALTH_SQL),
}
