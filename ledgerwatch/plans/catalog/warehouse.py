"""Star schema on the provided tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...operators import warehouse as ops
from . import profiles, reports, rules
from .base import Entry
from .inputs import COUNTRIES_SQL, EVENTS_SQL, MASTER_SQL, RAW_SQL, Inputs
from .profiles import EXTENDED_PROFILE_SQL
from .reports import _STATE_SQL, _with_state

AS_OF = datetime(2024, 2, 10)
SNAPSHOT = date(2024, 1, 30)


def key_sql(text: str) -> str:
    return f"CAST('0x' || substr(sha256({text}), 1, 15) AS BIGINT)"


# --- dimensions ---------------------------------------------------------------------


def dates(x: Inputs) -> DataFrame:
    return ops.dim_date(ops.date_bounds(x.events, "ts"))


_DATES_SQL = """
dates AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS full_date, CAST(isodow(d) AS INTEGER) AS day_of_week,
         strftime(d, '%A') AS day_name, CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
         CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_number,
         strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
         isodow(d) >= 6 AS is_weekend, isodow(d) <= 5 AS is_business_day, CAST(year(d) AS INTEGER) AS fiscal_year,
         CAST(quarter(d) AS INTEGER) AS fiscal_quarter, FALSE AS is_holiday
  FROM (SELECT CAST(unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS DATE) AS d
        FROM events))"""


_ORDER_DAYS_SQL = _DATES_SQL.replace("(ts)", "(o_orderdate)").replace("FROM events", "FROM orders")


def order_dates(x: Inputs) -> DataFrame:
    """Calendar over the years of the orders, with the days without orders as holidays."""
    orders = x.order_transactions
    bounds = ops.date_bounds(orders, "transaction_timestamp")
    calendar = ops.dim_date(bounds)
    quiet = calendar.join(
        orders.selectExpr("transaction_date AS full_date").distinct(), "full_date", "left_anti"
    ).selectExpr("full_date AS holiday_date", "'No orders' AS holiday_name")
    return ops.dim_date(bounds, quiet)


ORDER_DATES_SQL = f"""WITH {_ORDER_DAYS_SQL}
SELECT dates.* EXCLUDE (is_holiday), CASE WHEN o.d IS NULL THEN 'No orders' END AS holiday_name, o.d IS NULL AS is_holiday
FROM dates LEFT JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) o ON o.d = full_date"""


def geography(x: Inputs) -> DataFrame:
    used = x.raw.selectExpr("source_country AS country_code").union(
        x.raw.selectExpr("destination_country AS country_code")
    )
    return ops.dim_geography(used, ops.countries(x.spark))


_GEOGRAPHY_SQL = f"""
geography AS (
  SELECT {key_sql("country_code")} AS geography_sk, country_code, coalesce(country_name, 'UNKNOWN') AS country_name,
         coalesce(region, 'UNKNOWN') AS region,
         CASE WHEN risk_score >= 0.5 THEN 'HIGH' WHEN risk_score >= 0.3 THEN 'MEDIUM'
              WHEN risk_score IS NOT NULL THEN 'LOW' ELSE 'UNKNOWN' END AS risk_rating,
         risk_score, coalesce(risk_score >= 0.5, FALSE) AS is_high_risk, coalesce(risk_score >= 0.9, FALSE) AS is_sanctioned
  FROM (SELECT source_country AS country_code FROM raw UNION SELECT destination_country FROM raw)
  LEFT JOIN countries USING (country_code))"""


def customers(x: Inputs) -> DataFrame:
    """Versions of all customers: every third customer changed category in mid-January."""
    base = x.master.withColumns(
        {
            "number": F.expr("CAST(substring(customer_id, 2, 8) AS INT)"),
            "risk_score": F.expr("CAST(coalesce(risk_score, 0.3D) AS DECIMAL(5,4))"),
            "version": F.expr(
                "explode(CASE WHEN CAST(substring(customer_id, 2, 8) AS INT) % 3 = 0 THEN array(0, 1) ELSE array(2) END)"
            ),
        }
    )
    versions = base.selectExpr(
        "customer_id",
        "customer_name",
        "customer_segment",
        "country_of_residence",
        "is_pep",
        "kyc_status",
        "risk_score",
        "CASE WHEN version = 1 THEN 'HIGH' WHEN number % 4 = 0 THEN 'HIGH' ELSE 'LOW' END AS risk_category",
        "CASE WHEN version = 1 THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2023-01-01' END AS effective_date",
        "CASE WHEN version = 0 THEN TIMESTAMP '2024-01-15' END AS end_date",
        "version <> 0 AS is_current",
    )
    return ops.dim_customer(versions)


_CUSTOMERS_SQL = f"""
versions AS (
  SELECT customer_id, customer_name, customer_segment, country_of_residence, is_pep, kyc_status,
         CAST(coalesce(risk_score, 0.3) AS DECIMAL(5,4)) AS risk_score, CAST(substr(customer_id, 2) AS INTEGER) AS number,
         unnest(CASE WHEN CAST(substr(customer_id, 2) AS INTEGER) % 3 = 0 THEN [0, 1] ELSE [2] END) AS version
  FROM master),
dim_customer AS (
  SELECT customer_id, customer_name, customer_segment, country_of_residence, is_pep, kyc_status, risk_score,
         CASE WHEN version = 1 THEN 'HIGH' WHEN number % 4 = 0 THEN 'HIGH' ELSE 'LOW' END AS risk_category,
         CASE WHEN version = 1 THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2023-01-01' END AS effective_date,
         CASE WHEN version = 0 THEN TIMESTAMP '2024-01-15' END AS end_date, version <> 0 AS is_current,
         {key_sql("customer_id || '|' || CASE WHEN version = 1 THEN '2024-01-15' ELSE '2023-01-01' END")} AS customer_sk
  FROM versions)"""


def dim_rule(x: Inputs) -> DataFrame:
    return ops.dim_rule(x.spark, _with_state(rules.alerts(x, per_rule=True)))


DIM_RULE_SQL = f"""WITH {reports.EFFECTIVENESS_CTE},
catalogue(rule_id, rule_name, rule_category, threshold_value, threshold_currency, time_window_hours) AS (VALUES
  ('RULE_HV_001', 'High Value Transaction', 'VALUE', CAST(10000 AS DECIMAL(18,2)), 'EUR', NULL),
  ('RULE_VEL_001', 'Rapid Movement 24h', 'VELOCITY', 15000, 'EUR', 24),
  ('RULE_STR_001', 'Structuring Detection', 'STRUCTURING', 9000, 'EUR', 24),
  ('RULE_GEO_001', 'High Risk Country', 'PATTERN', NULL, NULL, NULL),
  ('RULE_PEP_001', 'PEP Customer', 'PATTERN', NULL, NULL, NULL),
  ('RULE_VEL_002', 'Unusual Transaction Frequency', 'VELOCITY', NULL, NULL, 24),
  ('RULE_TIME_001', 'Unusual Time', 'PATTERN', NULL, NULL, NULL),
  ('RULE_GEN_001', 'General Alert', 'PATTERN', NULL, NULL, NULL))
SELECT {key_sql("rule_id")} AS rule_key, rule_id, rule_name, rule_category, threshold_value, threshold_currency,
       time_window_hours, coalesce(total_alerts_generated, 0) AS total_alerts_generated,
       coalesce(true_positive_count, 0) AS true_positive_count, coalesce(false_positive_count, 0) AS false_positive_count,
       CASE WHEN true_positive_count + false_positive_count > 0
            THEN CAST(CAST(true_positive_count AS DOUBLE) / CAST(true_positive_count + false_positive_count AS DOUBLE) AS DECIMAL(5,4)) END AS precision_rate,
       TRUE AS is_active
FROM catalogue LEFT JOIN effect USING (rule_id)"""


def dim_account(x: Inputs) -> DataFrame:
    """All accounts; the open date of one known only from rows with a broken time is null."""
    typed = x.bronze.withColumn("transaction_date", F.try_to_timestamp("transaction_timestamp").cast("date"))
    return ops.dim_account(typed)


ACCOUNT_SQL = f"""WITH {EVENTS_SQL},
a AS (SELECT 'A' || lpad(CAST(user_id * 3 + event_id % 3 AS VARCHAR), 9, '0') AS account_id, customer_id,
             min(CASE WHEN event_id % 101 <> 0 THEN CAST(ts AS DATE) END) AS account_open_date FROM ev GROUP BY 1, 2)
SELECT {key_sql("account_id || '|' || customer_id")} AS account_key, account_id, customer_id, 'ACTIVE' AS account_status,
       account_open_date FROM a"""


# --- facts --------------------------------------------------------------------------


def facts(x: Inputs) -> DataFrame:
    return ops.fact_transaction(
        rules.enriched_b(x), customers(x), ops.dim_transaction_type(x.spark), geography(x)
    )


def facts_carried(x: Inputs) -> DataFrame:
    """The same facts, with customer versions carried forward instead of joined."""
    return ops.fact_transaction(
        rules.enriched_b(x), customers(x), ops.dim_transaction_type(x.spark), geography(x), carry_forward=True
    )


_FACT_SQL = f"""{rules.ENRICHED_B_SQL},{COUNTRIES_SQL},{_GEOGRAPHY_SQL},{_CUSTOMERS_SQL},
facts AS (
  SELECT {key_sql("transaction_id")} AS transaction_sk, transaction_id, coalesce(c.customer_sk, -1) AS customer_sk,
         {key_sql("transaction_type")} AS transaction_type_sk, {key_sql("source_country")} AS source_geography_sk,
         {key_sql("destination_country")} AS dest_geography_sk,
         CAST(strftime(transaction_timestamp, '%Y%m%d') AS INTEGER) AS transaction_date_sk, transaction_timestamp, processing_timestamp, amount,
         currency, channel, device_id, merchant_category, CAST(transaction_risk_score AS DECIMAL(5,4)) AS transaction_risk_score,
         is_suspicious, is_high_risk_country, is_large_amount, is_unusual_time,
         CAST(amount_vs_avg_ratio AS DECIMAL(10,2)) AS amount_vs_avg_ratio, rule_1_triggered, rule_2_triggered,
         rule_3_triggered, rule_4_triggered, rule_5_triggered, rule_6_triggered, total_rules_triggered
  FROM enriched e LEFT JOIN dim_customer c ON c.customer_id = e.customer_id AND c.effective_date <= e.transaction_timestamp
       AND (c.end_date IS NULL OR e.transaction_timestamp < c.end_date))"""


def alert_facts(x: Inputs) -> DataFrame:
    alerts = _with_state(rules.alerts_b(x))
    return ops.fact_alert(alerts, customers(x), ops.dim_alert_status(x.spark))


_ALERT_FACT_SQL = f"""{rules.ENRICHED_B_SQL},{_CUSTOMERS_SQL},
alert_facts AS (
  SELECT {key_sql("transaction_id || '|2024-01-31 00:00:00'")} AS alert_sk,
         sha256(transaction_id || '|' || alert_priority) AS alert_id, {key_sql("transaction_id")} AS transaction_sk,
         coalesce(c.customer_sk, -1) AS customer_sk, {_STATE_SQL} AS status_code,
         {key_sql(_STATE_SQL)} AS alert_status_sk, 20240131 AS alert_date_sk, TIMESTAMP '2024-01-31' AS alert_generated_at,
         alert_priority, CAST(transaction_risk_score AS DECIMAL(5,4)) AS transaction_risk_score, total_rules_triggered,
         CAST(NULL AS VARCHAR) AS reviewed_by, CAST(NULL AS TIMESTAMP) AS reviewed_at, CAST(NULL AS VARCHAR) AS resolution_notes,
         CAST(NULL AS VARCHAR) AS case_id, CAST(NULL AS BOOLEAN) AS is_str_filed, CAST(NULL AS TIMESTAMP) AS str_filed_date
  FROM enriched e LEFT JOIN dim_customer c ON c.customer_id = e.customer_id AND c.is_current WHERE is_suspicious)"""


def daily_metrics(x: Inputs) -> DataFrame:
    return ops.fact_customer_daily_metrics(facts(x))


def metrics_with_risk(x: Inputs) -> DataFrame:
    """Daily metrics with the current risk of their customer, whichever version was valid on the day."""
    return ops.with_current_risk(daily_metrics(x), customers(x)).select(
        "customer_sk", "metric_date_sk", "daily_transaction_count", "current_risk_score", "current_risk_category"
    )


METRICS_RISK_SQL = f"""WITH {_FACT_SQL},
daily AS (SELECT customer_sk, transaction_date_sk AS metric_date_sk, count(*) AS daily_transaction_count FROM facts GROUP BY ALL)
SELECT d.*, n.risk_score AS current_risk_score, n.risk_category AS current_risk_category
FROM daily d LEFT JOIN dim_customer v ON v.customer_sk = d.customer_sk LEFT JOIN dim_customer n ON n.customer_id = v.customer_id AND n.is_current"""

METRICS_SQL = f"""WITH {_FACT_SQL}
SELECT customer_sk, transaction_date_sk AS metric_date_sk, count(*) AS daily_transaction_count,
       max(amount) AS daily_max_transaction_amount, count(*) FILTER (WHERE is_suspicious) AS daily_suspicious_count,
       count(*) FILTER (WHERE is_high_risk_country) AS daily_high_risk_country_count,
       count(*) FILTER (WHERE is_large_amount) AS daily_large_amount_count,
       count(*) FILTER (WHERE is_unusual_time) AS daily_unusual_time_count,
       count(*) FILTER (WHERE channel = 'ONLINE') AS online_transaction_count,
       count(*) FILTER (WHERE channel = 'BRANCH') AS branch_transaction_count,
       count(*) FILTER (WHERE channel = 'ATM') AS atm_transaction_count,
       {key_sql("CAST(customer_sk AS VARCHAR) || '|' || CAST(transaction_date_sk AS VARCHAR)")} AS customer_daily_sk,
       CAST(sum(amount) AS DECIMAL(38,2)) AS daily_transaction_volume,
       CAST(sum(amount) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS daily_avg_transaction_amount
FROM facts GROUP BY customer_sk, transaction_date_sk"""


def monthly_summary(x: Inputs) -> DataFrame:
    return ops.monthly_summary(facts(x))


MONTHLY_SQL = f"""WITH {_FACT_SQL},
monthly AS (
SELECT strftime(transaction_timestamp, '%Y-%m') AS year_month, transaction_type_sk, dest_geography_sk AS geography_sk,
       count(*) AS transaction_count, CAST(sum(amount) AS DECIMAL(38,2)) AS total_volume,
       count(*) FILTER (WHERE is_suspicious) AS suspicious_count,
       CAST(coalesce(sum(amount) FILTER (WHERE is_suspicious), 0) AS DECIMAL(38,2)) AS suspicious_volume,
       count(DISTINCT customer_sk) AS unique_customers, CAST(sum(amount) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_amount
FROM facts GROUP BY 1, 2, 3)
SELECT *, {key_sql("year_month || '|' || CAST(transaction_type_sk AS VARCHAR) || '|' || CAST(geography_sk AS VARCHAR)")} AS summary_sk
FROM monthly"""


def risk_history(x: Inputs) -> DataFrame:
    return ops.customer_risk_history(facts(x), customers(x), SNAPSHOT)


HISTORY_SQL = f"""WITH {_FACT_SQL},
activity AS (
  SELECT customer_sk, count(*) AS total_transactions_30d, CAST(sum(amount) AS DECIMAL(38,2)) AS total_volume_30d,
         count(*) FILTER (WHERE is_suspicious) AS suspicious_count_30d,
         count(*) FILTER (WHERE is_high_risk_country) AS high_risk_country_count_30d
  FROM facts WHERE transaction_date_sk BETWEEN 20231231 AND 20240130 GROUP BY 1)
SELECT coalesce(a.customer_sk, c.customer_sk) AS customer_sk, coalesce(total_transactions_30d, 0) AS total_transactions_30d,
       CAST(coalesce(total_volume_30d, 0) AS DECIMAL(38,2)) AS total_volume_30d,
       coalesce(suspicious_count_30d, 0) AS suspicious_count_30d, coalesce(high_risk_country_count_30d, 0) AS high_risk_country_count_30d,
       risk_score, risk_category, DATE '2024-01-30' AS snapshot_date,
       {key_sql("CAST(coalesce(a.customer_sk, c.customer_sk) AS VARCHAR) || '|2024-01-30'")} AS risk_history_sk
FROM activity a FULL OUTER JOIN dim_customer c ON c.customer_sk = a.customer_sk
WHERE a.customer_sk IS NOT NULL OR c.is_current"""


# --- views --------------------------------------------------------------------------


def high_risk_customers(x: Inputs) -> DataFrame:
    return ops.high_risk_customers(customers(x))


HIGH_RISK_SQL = f"""WITH {MASTER_SQL},{_CUSTOMERS_SQL}
SELECT customer_id, customer_name, risk_score, risk_category, customer_segment, country_of_residence, is_pep
FROM dim_customer WHERE is_current AND risk_category = 'HIGH'"""


def open_alerts(x: Inputs) -> DataFrame:
    return ops.open_alerts(alert_facts(x), customers(x), ops.dim_alert_status(x.spark), F.lit(AS_OF))


OPEN_SQL = f"""WITH {_ALERT_FACT_SQL}
SELECT alert_id, v.customer_id, c.customer_name, alert_priority, transaction_risk_score, alert_generated_at,
       CAST(10 AS INTEGER) AS days_open, total_rules_triggered
FROM alert_facts a LEFT JOIN dim_customer v ON v.customer_sk = a.customer_sk
LEFT JOIN dim_customer c ON c.customer_id = v.customer_id AND c.is_current
WHERE status_code IN ('NEW', 'OPEN', 'UNDER_REVIEW', 'ESCALATED')"""


def volume_by_country(x: Inputs) -> DataFrame:
    return ops.volume_by_country(facts(x), dates(x), geography(x))


VOLUME_SQL = f"""WITH {_FACT_SQL}
SELECT CAST(transaction_timestamp AS DATE) AS full_date, country_name, risk_rating,
       CAST(count(*) AS BIGINT) AS transaction_count, CAST(sum(amount) AS DECIMAL(38,2)) AS total_volume,
       CAST(count(*) FILTER (WHERE is_suspicious) AS BIGINT) AS suspicious_count,
       CAST(sum(amount) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_amount
FROM facts JOIN geography ON geography_sk = dest_geography_sk GROUP BY 1, 2, 3"""


def partition_counts(x: Inputs) -> DataFrame:
    return ops.partition_counts(x.raw)


COUNTS_SQL = f"""WITH {RAW_SQL}
SELECT processing_date, count(*) AS record_count, count(DISTINCT customer_id) AS unique_customers FROM raw GROUP BY 1"""


def top_profiles(x: Inputs) -> DataFrame:
    return ops.top_risk_profiles(profiles.extended(x).withColumn("is_current", F.lit(True)))


TOP_SQL = f"""WITH {EXTENDED_PROFILE_SQL}
SELECT customer_id, risk_category, risk_score, total_transactions_30d, suspicious_transaction_count
FROM extended_profiles ORDER BY risk_score DESC, customer_id LIMIT 100"""


def skew_top100(x: Inputs) -> DataFrame:
    return ops.heaviest_keys(x.raw, "customer_id")


SKEW_SQL = f"""WITH {EVENTS_SQL}
SELECT customer_id, count(*) AS row_count FROM ev GROUP BY 1 ORDER BY row_count DESC, customer_id LIMIT 100"""


def transaction_types(x: Inputs) -> DataFrame:
    """Volume per type with the type's category and base risk."""
    counted = x.raw.groupBy("transaction_type").agg(F.count("*").alias("transaction_count"))
    types = ops.dim_transaction_type(x.spark)
    return types.join(counted, types["transaction_type_code"] == counted["transaction_type"], "left").select(
        "transaction_type_sk",
        "transaction_type_code",
        "transaction_type_name",
        "transaction_category",
        "base_risk_level",
        "is_active",
        F.coalesce("transaction_count", F.lit(0)).alias("transaction_count"),
    )


TYPES_SQL = f"""WITH {RAW_SQL},
t(transaction_type_code, transaction_type_name, transaction_category, base_risk_level) AS (VALUES
  ('ATM_WITHDRAWAL', 'ATM Withdrawal', 'CASH', CAST(0.10 AS DECIMAL(3,2))), ('POS_PURCHASE', 'POS Purchase', 'CARD', 0.05),
  ('ONLINE_TRANSFER', 'Online Transfer', 'TRANSFER', 0.30), ('WIRE_TRANSFER', 'Wire Transfer', 'TRANSFER', 0.50),
  ('CHECK_DEPOSIT', 'Check Deposit', 'DEPOSIT', 0.20), ('CASH_DEPOSIT', 'Cash Deposit', 'CASH', 0.40))
SELECT {key_sql("transaction_type_code")} AS transaction_type_sk, t.*, TRUE AS is_active,
       (SELECT count(*) FROM raw WHERE transaction_type = transaction_type_code) AS transaction_count FROM t"""


def alert_statuses(x: Inputs) -> DataFrame:
    """Alerts per life-cycle state, including the states that do not occur."""
    counted = _with_state(rules.alerts_b(x)).groupBy("alert_status").agg(F.count("*").alias("alert_count"))
    statuses = ops.dim_alert_status(x.spark)
    return statuses.join(counted, statuses["status_code"] == counted["alert_status"], "left").select(
        "alert_status_sk",
        "status_code",
        "status_name",
        "is_open",
        F.col("sort_order").cast("int").alias("sort_order"),
        F.coalesce("alert_count", F.lit(0)).alias("alert_count"),
    )


STATUSES_SQL = f"""WITH {rules.ENRICHED_B_SQL},
s(status_code, status_name, is_open, sort_order) AS (VALUES
  ('NEW', 'New', TRUE, 1), ('OPEN', 'Open', TRUE, 2), ('UNDER_REVIEW', 'Under review', TRUE, 3), ('ESCALATED', 'Escalated', TRUE, 4),
  ('REVIEWED', 'Reviewed', FALSE, 5), ('CLOSED', 'Closed', FALSE, 6), ('FALSE_POSITIVE', 'False positive', FALSE, 7)),
a AS (SELECT {_STATE_SQL} AS alert_status FROM enriched WHERE is_suspicious)
SELECT {key_sql("status_code")} AS alert_status_sk, s.*, (SELECT count(*) FROM a WHERE alert_status = status_code) AS alert_count FROM s"""


ENTRIES = {
    "dim_alert_status": Entry(alert_statuses, STATUSES_SQL),
    "dim_date": Entry(dates, f"WITH {_DATES_SQL}\nSELECT * FROM dates"),
    "dim_date_holidays": Entry(order_dates, ORDER_DATES_SQL),
    "dim_geography": Entry(geography, f"WITH {RAW_SQL},{COUNTRIES_SQL},{_GEOGRAPHY_SQL}\nSELECT * FROM geography"),
    "dim_customer": Entry(customers, f"WITH {MASTER_SQL},{_CUSTOMERS_SQL}\nSELECT * FROM dim_customer"),
    "dim_rule": Entry(dim_rule, DIM_RULE_SQL),
    "dim_account": Entry(dim_account, ACCOUNT_SQL),
    "dim_transaction_type": Entry(transaction_types, TYPES_SQL),
    "fact_transaction": Entry(facts, f"WITH {_FACT_SQL}\nSELECT * FROM facts"),
    "fact_transaction_carried": Entry(facts_carried, f"WITH {_FACT_SQL}\nSELECT * FROM facts"),
    "fact_alert": Entry(alert_facts, f"WITH {_ALERT_FACT_SQL}\nSELECT * EXCLUDE (status_code) FROM alert_facts"),
    "customer_daily_metrics": Entry(daily_metrics, METRICS_SQL),
    "customer_metrics_with_risk": Entry(metrics_with_risk, METRICS_RISK_SQL),
    "monthly_summary": Entry(monthly_summary, MONTHLY_SQL),
    "risk_history": Entry(risk_history, HISTORY_SQL),
    "high_risk_customers": Entry(high_risk_customers, HIGH_RISK_SQL),
    "open_alerts": Entry(open_alerts, OPEN_SQL),
    "volume_by_country": Entry(volume_by_country, VOLUME_SQL),
    "partition_counts": Entry(partition_counts, COUNTS_SQL),
    "top_profiles": Entry(top_profiles, TOP_SQL),
    "skew_top100": Entry(skew_top100, SKEW_SQL),
}
