"""Rule packs, scores and alerts."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...config import ProfileConfig, RuleConfigA, RuleConfigB
from ...operators import profiles, rules
from .. import alerting
from .base import Entry
from .inputs import ENRICHED_SQL, VELOCITY_SQL, Inputs

AS_OF = datetime(2024, 1, 31)
PACK_A = RuleConfigA()
# Lower limits, so that the rarer rules fire on the provided amounts as well.
SENSITIVE_A = RuleConfigA(high_frequency_count=5, structuring_count=2, extended=True, score_cap=100)
PACK_B = RuleConfigB(pep_wire_amount=Decimal("5000"), high_frequency_count=5)

FLAGS_A = [
    "rule_high_value",
    "rule_high_risk_country",
    "rule_unusual_time",
    "rule_pep_customer",
    "rule_rapid_movement",
    "rule_high_frequency",
]


def fill_pack_b(sql: str) -> str:
    return sql.replace("@PEP@", str(PACK_B.pep_wire_amount)).replace("@FREQ@", str(PACK_B.high_frequency_count))


def _rules_sql(frequency: int) -> str:
    return f"""{VELOCITY_SQL},
flagged AS (
  SELECT *, amount_eur > 10000 AS rule_high_value, is_high_risk_country AS rule_high_risk_country,
         is_unusual_time AS rule_unusual_time, is_pep AS rule_pep_customer,
         rolling_24h_amount > 15000 AS rule_rapid_movement, rolling_24h_count > {frequency} AS rule_high_frequency
  FROM vel),
scored AS (
  SELECT *, CAST(20 * CAST(rule_high_value AS INTEGER) + 30 * CAST(rule_high_risk_country AS INTEGER)
         + 10 * CAST(rule_unusual_time AS INTEGER) + 25 * CAST(rule_pep_customer AS INTEGER)
         + 25 * CAST(rule_rapid_movement AS INTEGER) + 15 * CAST(rule_high_frequency AS INTEGER)
         AS DECIMAL(5,2)) AS risk_score
  FROM flagged
  WHERE rule_high_value OR rule_high_risk_country OR rule_unusual_time OR rule_pep_customer
     OR rule_rapid_movement OR rule_high_frequency),
alerts AS (
  SELECT *, CASE WHEN risk_score >= 75 THEN 'CRITICAL' WHEN risk_score >= 50 THEN 'HIGH'
                 WHEN risk_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS alert_severity,
         CASE WHEN rule_high_value THEN 'RULE_HV_001' WHEN rule_rapid_movement THEN 'RULE_VEL_001'
              WHEN rule_high_risk_country THEN 'RULE_GEO_001' WHEN rule_pep_customer THEN 'RULE_PEP_001'
              WHEN rule_unusual_time THEN 'RULE_TIME_001' ELSE 'RULE_GEN_001' END AS rule_id
  FROM scored)"""


ALERTS_SQL = _rules_sql(10)

NAMES_SQL = """
names(rule_id, rule_name, rule_category) AS (VALUES
  ('RULE_HV_001', 'High Value Transaction', 'VALUE'), ('RULE_VEL_001', 'Rapid Movement', 'VELOCITY'),
  ('RULE_STR_001', 'Structuring Detection', 'STRUCTURING'), ('RULE_GEO_001', 'High Risk Country', 'PATTERN'),
  ('RULE_PEP_001', 'PEP Customer', 'PATTERN'), ('RULE_VEL_002', 'Unusual Transaction Frequency', 'VELOCITY'),
  ('RULE_TIME_001', 'Unusual Time', 'PATTERN'), ('RULE_GEN_001', 'General Alert', 'PATTERN'))"""


def rules_a(x: Inputs) -> DataFrame:
    scored = alerting.score_transactions(x.bronze, x.dimensions, PACK_A)
    return rules.evaluate_pack_a(scored, PACK_A).select("transaction_id", *FLAGS_A)


RULES_A_SQL = f"""WITH {ALERTS_SQL}
SELECT transaction_id, {", ".join(FLAGS_A)} FROM flagged"""


def alerts(x: Inputs, cfg: RuleConfigA = PACK_A, per_rule: bool = False) -> DataFrame:
    return alerting.build_alerts(x.bronze, x.dimensions, cfg, F.lit(AS_OF), per_rule)


def score_a(x: Inputs) -> DataFrame:
    return alerts(x).select("transaction_id", "risk_score", "alert_severity", "rule_id")


SCORE_A_SQL = f"""WITH {ALERTS_SQL}
SELECT transaction_id, risk_score, alert_severity, rule_id FROM alerts"""


def alerts_gold(x: Inputs) -> DataFrame:
    return rules.alert_columns(alerts(x))


GOLD_SQL = f"""WITH {ALERTS_SQL},{NAMES_SQL}
SELECT sha256(transaction_id || '|' || rule_id) AS alert_id, TIMESTAMP '2024-01-31' AS alert_timestamp,
       DATE '2024-01-31' AS alert_date, transaction_id, customer_id, account_id, rule_id, rule_name, rule_category,
       risk_score, CAST(0.85 AS DECIMAL(3,2)) AS confidence_score, alert_severity,
       amount_eur AS transaction_amount_eur, transaction_country_code AS transaction_country, transaction_type,
       customer_risk_category, 'NEW' AS alert_status, TIMESTAMP '2024-01-31' AS created_at
FROM alerts JOIN names USING (rule_id)"""


class Redelivered(Inputs):
    """The same transactions, every third delivered again an hour later."""

    @cached_property
    def bronze(self) -> DataFrame:
        again = super().bronze.filter("CAST(substring(transaction_id, 4, 10) AS BIGINT) % 3 = 0")
        return super().bronze.unionByName(again.withColumn("ingestion_timestamp", F.expr("ingestion_timestamp + INTERVAL 1 HOUR")))


def batch_redelivery(x: Inputs) -> DataFrame:
    return alerts_gold(Redelivered(x.spark, x.sf_dir))


def alerts_gold_full(x: Inputs) -> DataFrame:
    silver = alerting.build_silver(x.bronze, x.dimensions, PACK_A)
    context = profiles.customer_profiles(silver, AS_OF.date(), ProfileConfig())
    return rules.full_alert_columns(alerts(x), context, PACK_A)


GOLD_FULL_SQL = f"""WITH {ALERTS_SQL},{NAMES_SQL},
context AS (
  SELECT customer_id, sum(amount_eur) FILTER (WHERE transaction_date >= DATE '2024-01-01') AS total,
         count(*) FILTER (WHERE transaction_date >= DATE '2024-01-01') AS n
  FROM sv WHERE transaction_date BETWEEN DATE '2023-11-02' AND DATE '2024-01-31' GROUP BY 1)
SELECT sha256(transaction_id || '|' || rule_id) AS alert_id, TIMESTAMP '2024-01-31' AS alert_timestamp,
       DATE '2024-01-31' AS alert_date, transaction_id, customer_id, account_id, rule_id, rule_name, rule_category,
       transaction_timestamp AS rule_triggered_at, risk_score, CAST(0.85 AS DECIMAL(3,2)) AS confidence_score,
       alert_severity, amount_eur AS transaction_amount_eur, transaction_country_code AS transaction_country,
       transaction_type, customer_risk_category,
       CAST(round(CAST(total AS DOUBLE) / CAST(n AS DOUBLE), 2) AS DECIMAL(18,2)) AS customer_avg_transaction_amount,
       CAST(n AS INTEGER) AS customer_transaction_count_30d,
       '{{"high_value_threshold_eur":10000,"rapid_movement_threshold_eur":15000,"window_hours":24,"high_frequency_count":10}}' AS rule_parameters,
       '{{"rule_high_value":' || CAST(rule_high_value AS VARCHAR) || ',"rule_rapid_movement":' || CAST(rule_rapid_movement AS VARCHAR)
       || ',"rule_high_risk_country":' || CAST(rule_high_risk_country AS VARCHAR) || ',"rule_pep_customer":' || CAST(rule_pep_customer AS VARCHAR)
       || ',"rule_unusual_time":' || CAST(rule_unusual_time AS VARCHAR) || ',"rule_high_frequency":' || CAST(rule_high_frequency AS VARCHAR)
       || ',"rolling_24h_amount":"' || CAST(rolling_24h_amount AS VARCHAR) || '","rolling_24h_count":' || CAST(rolling_24h_count AS VARCHAR)
       || '}}' AS rule_evaluation_details,
       'NEW' AS alert_status, CAST(NULL AS BOOLEAN) AS false_positive_flag, CAST(NULL AS VARCHAR) AS investigation_notes,
       TIMESTAMP '2024-01-31' AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
FROM alerts JOIN names USING (rule_id) LEFT JOIN context USING (customer_id)"""


def alert_details_json(x: Inputs) -> DataFrame:
    """The JSON details of each alert, read back into columns."""
    silver = alerting.build_silver(x.bronze, x.dimensions, PACK_A)
    context = profiles.customer_profiles(silver, AS_OF.date(), ProfileConfig())
    return rules.read_details(rules.full_alert_columns(alerts(x), context, PACK_A), PACK_A)


DETAILS_JSON_SQL = f"""WITH {ALERTS_SQL}
SELECT sha256(transaction_id || '|' || rule_id) AS alert_id, rule_id, {", ".join(FLAGS_A)},
       rolling_24h_amount, rolling_24h_count FROM alerts"""


def alerts_extended(x: Inputs) -> DataFrame:
    """One row per raised rule, with structuring and velocity anomaly evaluated too."""
    return alerts(x, SENSITIVE_A, per_rule=True).select(
        "alert_id", "transaction_id", "rule_id", "rule_name", "rule_category", "risk_score", "alert_severity"
    )


EXTENDED_SQL = f"""WITH {VELOCITY_SQL},{NAMES_SQL},
daily AS (SELECT customer_id, transaction_date, count(*) AS daily_count FROM sv GROUP BY 1, 2),
based AS (
  SELECT *, sum(daily_count) OVER w AS past, min(transaction_date) OVER w AS first_day FROM daily
  WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_date
               RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)),
anomalies AS (
  SELECT customer_id, transaction_date FROM based
  WHERE daily_count > CAST(past AS DOUBLE) / CAST(transaction_date - first_day AS DOUBLE) * CAST(3 AS DOUBLE)),
raised AS (
  SELECT transaction_id, unnest([
    {{'r': 'RULE_HV_001', 'p': 20, 'on': amount_eur > 10000}},
    {{'r': 'RULE_VEL_001', 'p': 25, 'on': rolling_24h_amount > 15000}},
    {{'r': 'RULE_GEO_001', 'p': 30, 'on': is_high_risk_country}},
    {{'r': 'RULE_PEP_001', 'p': 25, 'on': is_pep}},
    {{'r': 'RULE_TIME_001', 'p': 10, 'on': is_unusual_time}},
    {{'r': 'RULE_STR_001', 'p': 20, 'on': structuring_24h_count >= 2}},
    {{'r': 'RULE_VEL_002', 'p': 15, 'on': a.customer_id IS NOT NULL}},
    {{'r': 'RULE_GEN_001', 'p': 15, 'on': rolling_24h_count > 5}}]) AS e
  FROM vel LEFT JOIN anomalies a USING (customer_id, transaction_date)),
hits AS (SELECT transaction_id, e.r AS rule_id, e.p AS points FROM raised WHERE e."on"),
totals AS (SELECT *, CAST(least(sum(points) OVER (PARTITION BY transaction_id), 100) AS DECIMAL(5,2)) AS risk_score FROM hits)
SELECT sha256(transaction_id || '|' || rule_id) AS alert_id, transaction_id, rule_id, rule_name, rule_category, risk_score,
       CASE WHEN risk_score >= 75 THEN 'CRITICAL' WHEN risk_score >= 50 THEN 'HIGH'
            WHEN risk_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS alert_severity
FROM totals JOIN names USING (rule_id)"""


def alert_routing(x: Inputs) -> DataFrame:
    """Messages for the urgent topic."""
    gold = rules.alert_columns(alerts(x)).select(
        "alert_id", "customer_id", "rule_id", "alert_severity", F.col("risk_score").cast("int").alias("score")
    )
    return rules.route_alerts(
        gold, ("CRITICAL", "HIGH")
    )


ROUTING_SQL = f"""WITH {ALERTS_SQL}
SELECT customer_id AS key,
       '{{"alert_id":"' || sha256(transaction_id || '|' || rule_id) || '","customer_id":"' || customer_id
       || '","rule_id":"' || rule_id || '","alert_severity":"' || alert_severity
       || '","score":' || CAST(CAST(risk_score AS INTEGER) AS VARCHAR) || '}}' AS value
FROM alerts WHERE alert_severity IN ('CRITICAL', 'HIGH')"""


def enriched_b(x: Inputs) -> DataFrame:
    return alerting.enrich_pack_b(x.raw, x.scoring_customers, PACK_B)


ENRICHED_B_SQL = fill_pack_b(ENRICHED_SQL)


def rules_b(x: Inputs) -> DataFrame:
    return enriched_b(x).select(
        "transaction_id", "amount_vs_avg_ratio", *rules.PACK_B_FLAGS, "total_rules_triggered"
    )


RULES_B_SQL = f"""WITH {ENRICHED_B_SQL}
SELECT transaction_id, amount_vs_avg_ratio, rule_1_triggered, rule_2_triggered, rule_3_triggered,
       rule_4_triggered, rule_5_triggered, rule_6_triggered, total_rules_triggered FROM enriched"""


def score_b(x: Inputs) -> DataFrame:
    return enriched_b(x).select("transaction_id", "transaction_risk_score", "is_suspicious", "alert_priority")


SCORE_B_SQL = f"""WITH {ENRICHED_B_SQL}
SELECT transaction_id, transaction_risk_score, is_suspicious, alert_priority FROM enriched"""


def alerts_b(x: Inputs) -> DataFrame:
    return rules.pack_b_alerts(enriched_b(x), F.lit(AS_OF))


ALERTS_B_SQL = f"""WITH {ENRICHED_B_SQL}
SELECT transaction_id, customer_id, transaction_type, CAST(amount AS DOUBLE) AS amount, currency, source_country,
       destination_country, transaction_timestamp, transaction_risk_score, alert_priority, total_rules_triggered,
       rule_1_triggered, rule_2_triggered, rule_3_triggered, rule_4_triggered, rule_5_triggered, rule_6_triggered,
       TIMESTAMP '2024-01-31' AS alert_generated_at, 'OPEN' AS alert_status, CAST(NULL AS VARCHAR) AS reviewed_by,
       CAST(NULL AS TIMESTAMP) AS reviewed_at, DATE '2024-01-31' AS processing_date
FROM enriched WHERE is_suspicious"""


ENTRIES = {
    "rules_a": Entry(rules_a, RULES_A_SQL),
    "score_a": Entry(score_a, SCORE_A_SQL),
    "alerts_gold": Entry(alerts_gold, GOLD_SQL),
    "batch_redelivery": Entry(batch_redelivery, GOLD_SQL),
    "alerts_gold_full": Entry(alerts_gold_full, GOLD_FULL_SQL),
    "alert_details_json": Entry(alert_details_json, DETAILS_JSON_SQL),
    "alerts_extended": Entry(alerts_extended, EXTENDED_SQL),
    "alert_routing": Entry(alert_routing, ROUTING_SQL),
    "rules_b": Entry(rules_b, RULES_B_SQL),
    "score_b": Entry(score_b, SCORE_B_SQL),
    "alerts_b": Entry(alerts_b, ALERTS_B_SQL),
}
