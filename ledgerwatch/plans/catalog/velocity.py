"""Moving-frame activity."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ...config import RuleConfigA
from ...operators import velocity as ops
from .. import alerting
from .base import Entry
from .inputs import SILVER_SQL, VELOCITY_SQL, Inputs

RULES = RuleConfigA()


def trailing_24h(x: Inputs) -> DataFrame:
    typed = alerting.typed_amounts(x.bronze, x.dimensions)
    return ops.trailing_velocity(typed, RULES).select(
        "transaction_id", "customer_id", "rolling_24h_amount", "rolling_24h_count", "rolling_24h_avg"
    )


TRAILING_SQL = f"""WITH {VELOCITY_SQL}
SELECT transaction_id, customer_id, rolling_24h_amount, rolling_24h_count,
       CAST(rolling_24h_amount AS DOUBLE) / CAST(rolling_24h_count AS DOUBLE) AS rolling_24h_avg FROM vel"""


def structuring(x: Inputs) -> DataFrame:
    """Transactions that are at least the second near-threshold one in 24 hours."""
    typed = alerting.typed_amounts(x.bronze, x.dimensions)
    return (
        ops.trailing_velocity(typed, RULES)
        .filter("structuring_24h_count >= 2")
        .select("transaction_id", "customer_id", "structuring_24h_count")
    )


STRUCTURING_SQL = f"""WITH {VELOCITY_SQL}
SELECT transaction_id, customer_id, structuring_24h_count FROM vel WHERE structuring_24h_count >= 2"""


def sliding_24h(x: Inputs) -> DataFrame:
    return ops.sliding_totals(alerting.typed_amounts(x.bronze, x.dimensions))


_SLIDING_SQL = f"""{SILVER_SQL},
sliding AS (
  SELECT customer_id, date_trunc('hour', transaction_timestamp) - to_hours(k) AS window_start,
         CAST(sum(amount_eur) AS DECIMAL(38,2)) AS rolling_24h_amount, count(*) AS rolling_24h_count
  FROM sv CROSS JOIN (SELECT CAST(unnest(range(0, 24)) AS INTEGER) AS k) GROUP BY 1, 2)"""

SLIDING_SQL = f"""WITH {_SLIDING_SQL}
SELECT customer_id, window_start, rolling_24h_amount, rolling_24h_count,
       window_start + INTERVAL 24 HOURS AS window_end,
       CAST(rolling_24h_amount AS DOUBLE) / CAST(rolling_24h_count AS DOUBLE) AS rolling_24h_avg
FROM sliding"""


def sliding_peak(x: Inputs) -> DataFrame:
    return ops.sliding_peak(alerting.typed_amounts(x.bronze, x.dimensions)).select(
        "transaction_id", "peak_24h_amount", "peak_24h_count"
    )


PEAK_SQL = f"""WITH {_SLIDING_SQL}
SELECT t.transaction_id, max(s.rolling_24h_amount) AS peak_24h_amount, max(s.rolling_24h_count) AS peak_24h_count
FROM sv t JOIN sliding s ON s.customer_id = t.customer_id
  AND t.transaction_timestamp >= s.window_start AND t.transaction_timestamp < s.window_start + INTERVAL 24 HOURS
GROUP BY t.transaction_id"""


def velocity_anomaly(x: Inputs) -> DataFrame:
    return ops.daily_velocity(alerting.typed_amounts(x.bronze, x.dimensions), RULES)


ANOMALY_SQL = f"""WITH {SILVER_SQL},
daily AS (SELECT customer_id, transaction_date, count(*) AS daily_count FROM sv GROUP BY 1, 2),
based AS (
  SELECT *, sum(daily_count) OVER w AS past, min(transaction_date) OVER w AS first_day FROM daily
  WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_date
               RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)),
rated AS (
  SELECT customer_id, transaction_date, daily_count,
         CAST(past AS DOUBLE) / CAST(transaction_date - first_day AS DOUBLE) AS baseline_daily_count FROM based)
SELECT *, coalesce(daily_count > baseline_daily_count * CAST(3 AS DOUBLE), FALSE) AS is_velocity_anomaly FROM rated"""


def hours_between(x: Inputs) -> DataFrame:
    return ops.time_between(alerting.typed_amounts(x.bronze, x.dimensions)).select(
        "transaction_id", "hours_since_previous"
    )


BETWEEN_SQL = f"""WITH {SILVER_SQL}
SELECT transaction_id,
       CAST(epoch_us(transaction_timestamp) - lag(epoch_us(transaction_timestamp)) OVER (
              PARTITION BY customer_id ORDER BY transaction_timestamp) AS DOUBLE)
         / CAST(3.6e9 AS DOUBLE) AS hours_since_previous
FROM sv"""


ENTRIES = {
    "trailing_24h": Entry(trailing_24h, TRAILING_SQL),
    "structuring": Entry(structuring, STRUCTURING_SQL),
    "sliding_24h": Entry(sliding_24h, SLIDING_SQL),
    "sliding_peak": Entry(sliding_peak, PEAK_SQL),
    "velocity_anomaly": Entry(velocity_anomaly, ANOMALY_SQL),
    "hours_between": Entry(hours_between, BETWEEN_SQL),
}
