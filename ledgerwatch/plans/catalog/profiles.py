"""Customer profiles."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...config import ProfileConfig, RuleConfigA
from ...operators import profiles as ops
from .. import alerting
from . import rules
from .base import Entry
from .inputs import SILVER_SQL, Inputs

RULES = RuleConfigA()
PROFILE = ProfileConfig()
# Half of the month lies in the 30 days before this day, all of it in the 90 days.
AS_OF = date(2024, 2, 15)
LATER = date(2024, 4, 10)


def _silver(x: Inputs) -> DataFrame:
    return alerting.build_silver(x.bronze, x.dimensions, RULES)


def _profiles(x: Inputs) -> DataFrame:
    return ops.customer_profiles(_silver(x), AS_OF, PROFILE)


_PROFILE_SQL = f"""{SILVER_SQL},
grouped AS (
  SELECT customer_id, count(*) AS transaction_count_90d,
         count(*) FILTER (WHERE transaction_type = 'DEBIT') AS debit_count_90d,
         count(*) FILTER (WHERE transaction_type = 'CREDIT') AS credit_count_90d,
         CAST(sum(amount_eur) AS DECIMAL(38,2)) AS total_amount_90d,
         max(amount_eur) AS max_transaction_amount_90d, min(amount_eur) AS min_transaction_amount_90d,
         count(*) FILTER (WHERE channel = 'ATM') AS atm_count_90d,
         count(*) FILTER (WHERE channel = 'ONLINE') AS online_count_90d,
         count(*) FILTER (WHERE channel = 'BRANCH') AS branch_count_90d,
         count(*) FILTER (WHERE is_high_value) AS high_value_count_90d,
         count(*) FILTER (WHERE is_international) AS international_count_90d,
         count(*) FILTER (WHERE is_high_risk_country) AS high_risk_country_count_90d,
         count(*) FILTER (WHERE is_unusual_time) AS unusual_time_count_90d,
         max(transaction_date) AS last_transaction_date
  FROM sv WHERE transaction_date BETWEEN DATE '2023-11-17' AND DATE '2024-02-15' GROUP BY customer_id),
recent AS (
  SELECT customer_id, count(*) AS transaction_count_30d,
         CAST(sum(amount_eur) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_transaction_amount_30d
  FROM sv WHERE transaction_date BETWEEN DATE '2024-01-16' AND DATE '2024-02-15' GROUP BY customer_id),
ratios AS (
  SELECT g.*, r.transaction_count_30d, r.avg_transaction_amount_30d,
         CAST(total_amount_90d AS DOUBLE) / CAST(transaction_count_90d AS DOUBLE) AS avg_transaction_amount_90d,
         CAST(total_amount_90d AS DOUBLE) / CAST(90 AS DOUBLE) AS avg_daily_amount_90d,
         CAST(high_value_count_90d AS DOUBLE) / CAST(transaction_count_90d AS DOUBLE) AS high_value_ratio,
         CAST(international_count_90d AS DOUBLE) / CAST(transaction_count_90d AS DOUBLE) AS international_ratio
  FROM grouped g LEFT JOIN recent r USING (customer_id)),
profiles AS (
  SELECT *, CASE WHEN high_value_ratio > 0.3 OR high_risk_country_count_90d > 5 OR avg_transaction_amount_90d > 50000 THEN 'HIGH'
                 WHEN high_value_ratio > 0.1 OR international_ratio > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category
  FROM ratios)"""

PROFILE_COLUMNS = [
    "customer_id",
    "transaction_count_90d",
    "debit_count_90d",
    "credit_count_90d",
    "total_amount_90d",
    "max_transaction_amount_90d",
    "min_transaction_amount_90d",
    "atm_count_90d",
    "online_count_90d",
    "branch_count_90d",
    "high_value_count_90d",
    "international_count_90d",
    "high_risk_country_count_90d",
    "unusual_time_count_90d",
    "last_transaction_date",
    "transaction_count_30d",
    "avg_transaction_amount_30d",
    "avg_transaction_amount_90d",
]


def profile_90d_30d(x: Inputs) -> DataFrame:
    return _profiles(x).select(*PROFILE_COLUMNS)


def profile_ratios(x: Inputs) -> DataFrame:
    return _profiles(x).select("customer_id", "avg_daily_amount_90d", "high_value_ratio", "international_ratio")


def profile_category(x: Inputs) -> DataFrame:
    return _profiles(x).select("customer_id", "risk_category")


def category_summary(x: Inputs) -> DataFrame:
    summary = ops.category_summary(_profiles(x))
    return summary.withColumns({c: F.round(c, 4) for c in ("avg_amount", "avg_tx_count")})


SUMMARY_SQL = f"""WITH {_PROFILE_SQL}
SELECT risk_category, count(*) AS customer_count, round(avg(avg_transaction_amount_90d), 4) AS avg_amount,
       round(avg(CAST(transaction_count_90d AS DOUBLE)), 4) AS avg_tx_count
FROM profiles GROUP BY risk_category"""


_MEASURES = ["stddev_transaction_amount", "avg_hours_between_transactions", "stddev_hours_between_transactions"]


def extended(x: Inputs) -> DataFrame:
    """As of a day from which the last 90 days leave part of the transactions out."""
    return ops.extended_profiles(rules.enriched_b(x).drop("is_pep"), x.master, LATER, PROFILE)


def profile_extended(x: Inputs) -> DataFrame:
    """Deviations are rounded: they are sums of squares in any order."""
    wide = extended(x)
    return wide.withColumns({c: F.round(c, 3) for c in _MEASURES})


EXTENDED_PROFILE_SQL = f"""{rules.ENRICHED_B_SQL},
gaps AS (
  SELECT customer_id, (epoch_us(transaction_timestamp) - lag(epoch_us(transaction_timestamp)) OVER (
           PARTITION BY customer_id ORDER BY transaction_timestamp)) / CAST(3.6e9 AS DOUBLE) AS gap
  FROM enriched),
gap_stats AS (
  SELECT customer_id, round(avg(gap), 3) AS avg_hours_between_transactions,
         round(stddev_samp(gap), 3) AS stddev_hours_between_transactions FROM gaps GROUP BY 1),
behaviour AS (
  SELECT customer_id, count(*) AS total_transactions, CAST(sum(amount) AS DECIMAL(38,2)) AS total_volume,
    max(amount) AS max_transaction_amount,
    round(stddev_samp(CAST(amount AS DOUBLE)), 3) AS stddev_transaction_amount,
    count(*) FILTER (WHERE transaction_date >= DATE '2024-01-11') AS total_transactions_90d,
    CAST(coalesce(sum(amount) FILTER (WHERE transaction_date >= DATE '2024-01-11'), 0) AS DECIMAL(38,2)) AS total_volume_90d,
    count(*) FILTER (WHERE transaction_date >= DATE '2024-03-11') AS total_transactions_30d,
    CAST(coalesce(sum(amount) FILTER (WHERE transaction_date >= DATE '2024-03-11'), 0) AS DECIMAL(38,2)) AS total_volume_30d,
    count(*) FILTER (WHERE transaction_type = 'WIRE_TRANSFER') AS wire_transfer_count,
    count(*) FILTER (WHERE transaction_type = 'CASH_DEPOSIT') AS cash_deposit_count,
    count(*) FILTER (WHERE transaction_type = 'ONLINE_TRANSFER') AS online_transfer_count,
    count(*) FILTER (WHERE is_high_risk_country) AS high_risk_country_count,
    count(*) FILTER (WHERE is_large_amount) AS large_amount_count,
    count(*) FILTER (WHERE is_unusual_time) AS unusual_time_count,
    count(*) FILTER (WHERE is_suspicious) AS suspicious_transaction_count,
    CAST(count(DISTINCT source_country) AS INTEGER) AS unique_source_countries,
    CAST(count(DISTINCT destination_country) AS INTEGER) AS unique_destination_countries,
    count(*) FILTER (WHERE channel = 'ONLINE') AS online_channel_count,
    count(*) FILTER (WHERE channel = 'BRANCH') AS branch_channel_count,
    count(*) FILTER (WHERE channel = 'ATM') AS atm_channel_count,
    count(*) FILTER (WHERE isodow(transaction_timestamp) >= 6) AS weekend_transactions,
    count(*) FILTER (WHERE isodow(transaction_timestamp) < 6) AS weekday_transactions,
    count(*) FILTER (WHERE hour(transaction_timestamp) BETWEEN 6 AND 11) AS morning_transactions,
    count(*) FILTER (WHERE hour(transaction_timestamp) BETWEEN 12 AND 17) AS afternoon_transactions,
    count(*) FILTER (WHERE hour(transaction_timestamp) BETWEEN 18 AND 21) AS evening_transactions,
    count(*) FILTER (WHERE hour(transaction_timestamp) >= 22 OR hour(transaction_timestamp) < 6) AS night_transactions,
    max(transaction_timestamp) AS last_transaction_date
  FROM enriched GROUP BY customer_id),
joined AS (
  SELECT b.*, CAST(total_volume AS DOUBLE) / CAST(total_transactions AS DOUBLE) AS avg_transaction_amount,
         CASE WHEN total_transactions_30d > 0
              THEN CAST(total_volume_30d AS DOUBLE) / CAST(total_transactions_30d AS DOUBLE) END AS avg_amount_30d,
         avg_hours_between_transactions, stddev_hours_between_transactions,
         customer_name, customer_segment, account_open_date,
         CAST(DATE '2024-04-10' - account_open_date AS INTEGER) AS account_age_days, country_of_residence,
         m.is_pep, kyc_status,
         round(least(1.0, CAST(total_volume AS DOUBLE) / 1000000.0), 4) AS volume_risk,
         round(least(1.0, CAST(total_transactions AS DOUBLE) / 300.0), 4) AS frequency_risk,
         round(CAST(high_risk_country_count AS DOUBLE) / total_transactions, 4) AS high_risk_country_risk,
         round(CAST(suspicious_transaction_count AS DOUBLE) / total_transactions, 4) AS suspicious_activity_risk,
         round(CAST(unusual_time_count AS DOUBLE) / total_transactions, 4) AS unusual_behavior_risk,
         CASE WHEN m.is_pep THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS pep_risk,
         round(CAST(cash_deposit_count AS DOUBLE) / total_transactions, 4) AS cash_risk
  FROM behaviour b LEFT JOIN gap_stats USING (customer_id) LEFT JOIN master m USING (customer_id)),
weighed AS (
  SELECT *, round(volume_risk * CAST(0.2 AS DOUBLE) + frequency_risk * CAST(0.15 AS DOUBLE)
            + high_risk_country_risk * CAST(0.2 AS DOUBLE) + suspicious_activity_risk * CAST(0.2 AS DOUBLE)
            + unusual_behavior_risk * CAST(0.1 AS DOUBLE) + pep_risk * CAST(0.1 AS DOUBLE)
            + cash_risk * CAST(0.05 AS DOUBLE), 4) AS risk_score
  FROM joined),
extended_profiles AS (
  SELECT *, CASE WHEN risk_score >= 0.5 THEN 'HIGH' WHEN risk_score >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category
  FROM weighed)"""


def daily_summary(x: Inputs) -> DataFrame:
    stamp = F.lit(datetime(2024, 1, 31))
    return ops.daily_summary(_silver(x), rules.alerts(x), stamp)


DAILY_SQL = f"""WITH {rules.ALERTS_SQL},
activity AS (
  SELECT customer_id, transaction_date AS summary_date, count(*) AS n, sum(amount_eur) AS total,
         max(amount_eur) AS top, min(amount_eur) AS low,
         count(*) FILTER (WHERE transaction_type = 'DEBIT') AS debit,
         count(*) FILTER (WHERE transaction_type = 'CREDIT') AS credit,
         count(*) FILTER (WHERE is_international) AS international,
         count(*) FILTER (WHERE is_high_risk_country) AS risky,
         count(*) FILTER (WHERE channel = 'ATM') AS atm, count(*) FILTER (WHERE channel = 'ONLINE') AS online,
         count(*) FILTER (WHERE channel = 'BRANCH') AS branch
  FROM sv GROUP BY 1, 2),
raised AS (
  SELECT customer_id, transaction_date AS summary_date, count(*) AS alert_count,
         count(*) FILTER (WHERE alert_severity IN ('HIGH', 'CRITICAL')) AS high_count
  FROM alerts GROUP BY 1, 2)
SELECT customer_id, summary_date, CAST(n AS INTEGER) AS transaction_count, CAST(total AS DECIMAL(18,2)) AS total_amount_eur,
       CAST(CAST((CAST(total * 100 AS HUGEINT) * 2 + n) // (2 * n) AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2))
            AS DECIMAL(18,2)) AS avg_transaction_amount,
       top AS max_transaction_amount, low AS min_transaction_amount,
       CAST(debit AS INTEGER) AS debit_count, CAST(credit AS INTEGER) AS credit_count,
       CAST(international AS INTEGER) AS international_count, CAST(risky AS INTEGER) AS high_risk_country_count,
       CAST(atm AS INTEGER) AS atm_count, CAST(online AS INTEGER) AS online_count, CAST(branch AS INTEGER) AS branch_count,
       CAST(coalesce(alert_count, 0) AS INTEGER) AS alert_count,
       CAST(coalesce(high_count, 0) AS INTEGER) AS high_severity_alert_count, TIMESTAMP '2024-01-31' AS computed_at
FROM activity LEFT JOIN raised USING (customer_id, summary_date)"""


ENTRIES = {
    "profile_90d_30d": Entry(profile_90d_30d, f"WITH {_PROFILE_SQL}\nSELECT {', '.join(PROFILE_COLUMNS)} FROM profiles"),
    "profile_ratios": Entry(
        profile_ratios,
        f"WITH {_PROFILE_SQL}\nSELECT customer_id, avg_daily_amount_90d, high_value_ratio, international_ratio FROM profiles",
    ),
    "profile_category": Entry(profile_category, f"WITH {_PROFILE_SQL}\nSELECT customer_id, risk_category FROM profiles"),
    "category_summary": Entry(category_summary, SUMMARY_SQL),
    "profile_extended": Entry(profile_extended, f"WITH {EXTENDED_PROFILE_SQL}\nSELECT * FROM extended_profiles"),
    "daily_summary": Entry(daily_summary, DAILY_SQL),
}
