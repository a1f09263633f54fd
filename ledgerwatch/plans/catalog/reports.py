"""Daily and weekly reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...operators import reports as ops
from ...operators import warehouse
from . import rules
from .base import Entry
from .inputs import RAW_SQL, Inputs

AS_OF = datetime(2024, 1, 31)
DAY = date(2024, 1, 31)
WEEK_ENDING = date(2024, 1, 20)

# Alerts get a life-cycle state from their id, so that every state occurs.
STATES = ("OPEN", "REVIEWED", "ESCALATED", "FALSE_POSITIVE", "NEW")


def _with_state(alerts: DataFrame) -> DataFrame:
    state = "element_at(array({}), CAST(CAST(substring(transaction_id, 4, 10) AS BIGINT) % {} AS INT) + 1)"
    return alerts.withColumn("alert_status", F.expr(state.format(", ".join(f"'{s}'" for s in STATES), len(STATES))))


_STATE_SQL = "list_extract([{}], CAST(CAST(substr(transaction_id, 4) AS BIGINT) % {} AS INTEGER) + 1)".format(
    ", ".join(f"'{s}'" for s in STATES), len(STATES)
)

# Exact decimal amounts; the alert table itself stores doubles.
_DAILY_SQL = f"""{rules.ENRICHED_B_SQL},
al AS (SELECT e.*, m.customer_name, CASE WHEN m.customer_name IS NULL THEN NULL WHEN m.risk_score > 0.3 THEN 'HIGH' ELSE 'LOW' END AS risk_category,
              {_STATE_SQL} AS alert_status
       FROM enriched e LEFT JOIN master m USING (customer_id) WHERE is_suspicious)"""


def daily_alerts(x: Inputs) -> DataFrame:
    """Suspicious transactions with their state and current customer attributes."""
    enriched = rules.enriched_b(x)
    alerts = _with_state(enriched.filter("is_suspicious")).select(
        "transaction_id",
        "customer_id",
        "amount",
        "destination_country",
        "transaction_timestamp",
        "transaction_risk_score",
        "alert_priority",
        "alert_status",
        "total_rules_triggered",
        *[f"rule_{i}_triggered" for i in range(1, 7)],
    )
    details = x.raw.withColumn("amount_vs_avg_ratio", F.lit(None).cast("double"))
    current = x.master.selectExpr(
        "customer_id",
        "customer_name",
        "customer_segment",
        "CASE WHEN risk_score > 0.3 THEN 'HIGH' ELSE 'LOW' END AS risk_category",
        "datediff(DATE '2024-01-31', account_open_date) AS account_age_days",
        "country_of_residence",
        "kyc_status",
        "TRUE AS is_current",
    )
    return ops.enrich_alerts(alerts, details, current)


def alert_details(x: Inputs) -> DataFrame:
    return daily_alerts(x).select(
        "transaction_id", "customer_id", "merchant_category", "channel", "device_id", "customer_name",
        "customer_segment", "risk_category", "account_age_days", "country_of_residence", "kyc_status",
    )


DETAILS_SQL = f"""WITH {_DAILY_SQL}
SELECT transaction_id, customer_id, merchant_category, channel, device_id, al.customer_name, customer_segment,
       risk_category, CAST(DATE '2024-01-31' - account_open_date AS INTEGER) AS account_age_days, country_of_residence, kyc_status
FROM al LEFT JOIN master USING (customer_id)"""


def alert_summary(x: Inputs) -> DataFrame:
    return ops.alert_summary(daily_alerts(x))


SUMMARY_SQL = f"""WITH {_DAILY_SQL}
SELECT alert_priority, count(transaction_id) AS alert_count, sum(amount) AS total_amount,
       CAST(sum(amount) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_amount,
       count(DISTINCT customer_id) AS unique_customers,
       count(*) FILTER (WHERE alert_status IN ('OPEN', 'NEW')) AS open_alerts,
       count(*) FILTER (WHERE alert_status = 'REVIEWED') AS reviewed_alerts
FROM al GROUP BY alert_priority"""


def rule_breakdown(x: Inputs) -> DataFrame:
    return ops.rule_breakdown(daily_alerts(x))


BREAKDOWN_SQL = f"WITH {_DAILY_SQL}\nSELECT " + ", ".join(
    f"count(*) FILTER (WHERE {flag}) AS {name}" for flag, name in ops.RULE_COUNTERS.items()
) + " FROM al"


def customer_risk(x: Inputs) -> DataFrame:
    return ops.customer_risk(daily_alerts(x))


def customer_flagged_transactions(x: Inputs) -> DataFrame:
    return ops.customer_flagged_transactions(daily_alerts(x))


_SCORE_MEAN = "CAST(sum(CAST(transaction_risk_score AS DECIMAL(5,4))) AS DOUBLE) / CAST(count(*) AS DOUBLE)"

CUSTOMER_RISK_SQL = f"""WITH {_DAILY_SQL}
SELECT customer_id, customer_name, risk_category, count(transaction_id) AS alert_count,
       sum(amount) AS total_flagged_amount, {_SCORE_MEAN} AS avg_risk_score,
       CASE min(CASE alert_priority WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END)
            WHEN 1 THEN 'CRITICAL' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'MEDIUM' ELSE 'LOW' END AS highest_priority,
       count(DISTINCT destination_country) AS unique_dest_countries
FROM al GROUP BY customer_id, customer_name, risk_category"""

FLAGGED_SQL = f"""WITH {_DAILY_SQL}
SELECT DISTINCT customer_id, transaction_id FROM al WHERE transaction_id IS NOT NULL"""


def geo_report(x: Inputs) -> DataFrame:
    return ops.geographic(daily_alerts(x))


GEO_SQL = f"""WITH {_DAILY_SQL}
SELECT destination_country, count(transaction_id) AS alert_count, sum(amount) AS total_amount,
       count(DISTINCT customer_id) AS unique_customers, {_SCORE_MEAN} AS avg_risk_score
FROM al GROUP BY destination_country"""


def compliance_kpis(x: Inputs) -> DataFrame:
    return ops.compliance_kpis(daily_alerts(x), DAY, F.lit(AS_OF))


KPI_SQL = f"""WITH {_DAILY_SQL}
SELECT DATE '2024-01-31' AS report_date, count(*) AS total_alerts,
       count(*) FILTER (WHERE alert_priority = 'CRITICAL') AS critical_alerts,
       count(*) FILTER (WHERE alert_priority = 'HIGH') AS high_alerts, coalesce(sum(amount), 0) AS total_flagged_amount,
       count(DISTINCT customer_id) AS unique_customers,
       count(*) FILTER (WHERE alert_status IN ('OPEN', 'NEW')) AS open_alerts, TIMESTAMP '2024-01-31' AS generated_at
FROM al"""


def weekly_summary(x: Inputs) -> DataFrame:
    return ops.weekly_summary(ops.in_week(rules.enriched_b(x), WEEK_ENDING))


_WEEK_SQL = f"""{rules.ENRICHED_B_SQL},
week AS (SELECT * FROM enriched WHERE processing_date BETWEEN DATE '2024-01-13' AND DATE '2024-01-20')"""

WEEKLY_SQL = f"""WITH {_WEEK_SQL}
SELECT transaction_type, count(transaction_id) AS transaction_count, sum(amount) AS total_volume,
       CAST(sum(amount) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_amount,
       count(*) FILTER (WHERE is_suspicious) AS suspicious_count
FROM week GROUP BY transaction_type"""


def weekly_trends(x: Inputs) -> DataFrame:
    return ops.weekly_trends(ops.in_week(rules.enriched_b(x), WEEK_ENDING))


TRENDS_SQL = f"""WITH {_WEEK_SQL}
SELECT customer_id, count(transaction_id) AS weekly_transaction_count, sum(amount) AS weekly_volume,
       {_SCORE_MEAN} AS avg_risk_score, max(transaction_risk_score) AS max_risk_score
FROM week GROUP BY customer_id"""


def week_over_week(x: Inputs) -> DataFrame:
    return ops.week_over_week(x.raw)


WOW_SQL = f"""WITH {RAW_SQL},
weekly AS (
  SELECT customer_id, CAST(date_trunc('week', transaction_timestamp) AS DATE) AS week_start,
         count(*) AS weekly_transaction_count, CAST(sum(amount) AS DECIMAL(38,2)) AS weekly_volume FROM raw GROUP BY 1, 2),
lagged AS (SELECT *, lag(weekly_volume) OVER (PARTITION BY customer_id ORDER BY week_start) AS previous_volume FROM weekly)
SELECT *, CAST(weekly_volume - previous_volume AS DOUBLE) / CAST(previous_volume AS DOUBLE) AS volume_change_ratio FROM lagged"""


def weekly_alerts(x: Inputs) -> DataFrame:
    return ops.weekly_alerts(rules.alerts(x))


WEEKLY_ALERTS_SQL = f"""WITH {rules.ALERTS_SQL}
SELECT CAST(date_trunc('week', transaction_timestamp) AS DATE) AS week_start, rule_id, alert_severity,
       count(*) AS alert_count, CAST(sum(amount_eur) AS DECIMAL(38,2)) AS total_amount_eur,
       count(DISTINCT customer_id) AS unique_customers
FROM alerts GROUP BY 1, 2, 3"""


def rule_effectiveness(x: Inputs) -> DataFrame:
    return ops.rule_effectiveness(_with_state(rules.alerts(x, per_rule=True)))


EFFECTIVENESS_CTE = f"""{rules.ALERTS_SQL},
per_rule AS (
  SELECT transaction_id, {_STATE_SQL} AS alert_status, unnest(list_filter([
     CASE WHEN rule_high_value THEN 'RULE_HV_001' END, CASE WHEN rule_rapid_movement THEN 'RULE_VEL_001' END,
     CASE WHEN rule_high_risk_country THEN 'RULE_GEO_001' END, CASE WHEN rule_pep_customer THEN 'RULE_PEP_001' END,
     CASE WHEN rule_unusual_time THEN 'RULE_TIME_001' END, CASE WHEN rule_high_frequency THEN 'RULE_GEN_001' END],
     lambda r: r IS NOT NULL)) AS rule_id
  FROM alerts),
effect AS (
  SELECT rule_id, count(*) AS total_alerts_generated,
         count(*) FILTER (WHERE alert_status = 'ESCALATED') AS true_positive_count,
         count(*) FILTER (WHERE alert_status = 'FALSE_POSITIVE') AS false_positive_count
  FROM per_rule GROUP BY rule_id)"""

EFFECTIVENESS_SQL = f"""WITH {EFFECTIVENESS_CTE}
SELECT *, CASE WHEN true_positive_count + false_positive_count > 0
               THEN CAST(true_positive_count AS DOUBLE) / CAST(true_positive_count + false_positive_count AS DOUBLE) END AS precision_rate
FROM effect"""


def alerts_by_region(x: Inputs) -> DataFrame:
    return ops.alerts_by_region(rules.alerts(x), warehouse.countries(x.spark))


REGION_SQL = f"""WITH {rules.ALERTS_SQL}
SELECT rule_id, coalesce(region, 'UNKNOWN') AS region, customer_risk_category, count(*) AS alert_count,
       CAST(sum(amount_eur) AS DECIMAL(38,2)) AS total_amount_eur
FROM alerts LEFT JOIN countries ON country_code = transaction_country_code GROUP BY 1, 2, 3"""


ENTRIES = {
    "alert_details": Entry(alert_details, DETAILS_SQL),
    "alert_summary": Entry(alert_summary, SUMMARY_SQL),
    "rule_breakdown": Entry(rule_breakdown, BREAKDOWN_SQL),
    "customer_risk": Entry(customer_risk, CUSTOMER_RISK_SQL),
    "customer_flagged_transactions": Entry(customer_flagged_transactions, FLAGGED_SQL),
    "geo_report": Entry(geo_report, GEO_SQL),
    "compliance_kpis": Entry(compliance_kpis, KPI_SQL),
    "weekly_summary": Entry(weekly_summary, WEEKLY_SQL),
    "weekly_trends": Entry(weekly_trends, TRENDS_SQL),
    "week_over_week": Entry(week_over_week, WOW_SQL),
    "weekly_alerts": Entry(weekly_alerts, WEEKLY_ALERTS_SQL),
    "rule_effectiveness": Entry(rule_effectiveness, EFFECTIVENESS_SQL),
    "alerts_by_region": Entry(alerts_by_region, REGION_SQL),
}
