"""The two rule packs and the alerts they raise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import RuleConfigA, RuleConfigB
from ..functions import flags, keys, risk

PACK_B_FLAGS = [f"rule_{i}_triggered" for i in range(1, 7)]


# --- rule pack A: additive points -------------------------------------------------


def evaluate_pack_a(df: DataFrame, cfg: RuleConfigA) -> DataFrame:
    """One boolean per rule; a NULL input never raises a rule."""
    raised = {
        "rule_high_value": F.col("amount_eur") > F.lit(cfg.high_value_threshold_eur),
        "rule_high_risk_country": F.col("is_high_risk_country"),
        "rule_unusual_time": F.col("is_unusual_time"),
        "rule_pep_customer": F.col("is_pep"),
        "rule_rapid_movement": F.col("rolling_24h_amount") > F.lit(cfg.rapid_movement_threshold_eur),
        "rule_high_frequency": F.col("rolling_24h_count") > cfg.high_frequency_count,
    }
    if cfg.extended:
        raised["rule_structuring"] = F.col("structuring_24h_count") >= cfg.structuring_count
        raised["rule_velocity_anomaly"] = F.col("is_velocity_anomaly")
    return df.withColumns({name: flags.is_true(value) for name, value in raised.items()})


def any_rule(df: DataFrame, cfg: RuleConfigA) -> DataFrame:
    """Rows that raised at least one rule."""
    return df.filter(flags.any_true([F.col(r.flag) for r in risk.pack_a(cfg)]))


def score_pack_a(df: DataFrame, cfg: RuleConfigA) -> DataFrame:
    return df.withColumn("risk_score", risk.points_score(cfg)).withColumn(
        "alert_severity", risk.severity(F.col("risk_score"), cfg)
    )


def name_alerts(df: DataFrame, cfg: RuleConfigA, per_rule: bool = False) -> DataFrame:
    """Rule id, name, category and alert id.

    One row per transaction named by its primary rule, or one row per
    (transaction, raised rule) when ``per_rule``.
    """
    if per_rule:
        df = df.withColumn("rule_id", F.explode(risk.raised_rules(cfg)))
    else:
        df = df.withColumn("rule_id", risk.primary_rule(cfg))
    return df.withColumns(
        {
            "rule_name": risk.alert_name("rule_id"),
            "rule_category": risk.rule_category("rule_id"),
            "alert_id": keys.alert_id(F.col("transaction_id"), F.col("rule_id")),
        }
    )


def raise_alerts(
    df: DataFrame, cfg: RuleConfigA, raised_at: Column, per_rule: bool = False
) -> DataFrame:
    """Evaluate, filter, score and name; keeps the transaction columns."""
    scored = score_pack_a(any_rule(evaluate_pack_a(df, cfg), cfg), cfg)
    return name_alerts(scored, cfg, per_rule).withColumns(
        {
            "alert_timestamp": raised_at,
            "alert_date": F.to_date(raised_at),
            "alert_status": F.lit("NEW"),
            "confidence_score": F.lit(cfg.confidence).cast("decimal(3,2)"),
            "created_at": raised_at,
        }
    )


def alert_columns(alerts: DataFrame) -> DataFrame:
    """The 18 columns the alert stream emits."""
    return alerts.select(
        "alert_id",
        "alert_timestamp",
        "alert_date",
        "transaction_id",
        "customer_id",
        "account_id",
        "rule_id",
        "rule_name",
        "rule_category",
        "risk_score",
        "confidence_score",
        "alert_severity",
        F.col("amount_eur").alias("transaction_amount_eur"),
        F.col("transaction_country_code").alias("transaction_country"),
        "transaction_type",
        "customer_risk_category",
        "alert_status",
        "created_at",
    )


def full_alert_columns(alerts: DataFrame, profiles: DataFrame, cfg: RuleConfigA) -> DataFrame:
    """Every declared alert column, with customer context and JSON details.

    ``profiles`` has one row per customer: ``avg_transaction_amount_30d`` and
    ``transaction_count_30d``.
    """
    context = profiles.select(
        "customer_id",
        F.col("avg_transaction_amount_30d").cast("decimal(18,2)").alias("customer_avg_transaction_amount"),
        F.col("transaction_count_30d").cast("int").alias("customer_transaction_count_30d"),
    )
    parameters = F.struct(
        F.lit(int(cfg.high_value_threshold_eur)).alias("high_value_threshold_eur"),
        F.lit(int(cfg.rapid_movement_threshold_eur)).alias("rapid_movement_threshold_eur"),
        F.lit(cfg.velocity_window_hours).alias("window_hours"),
        F.lit(cfg.high_frequency_count).alias("high_frequency_count"),
    )
    details = F.struct(
        *[F.col(r.flag) for r in risk.pack_a(cfg)],
        F.col("rolling_24h_amount").cast("string").alias("rolling_24h_amount"),
        F.col("rolling_24h_count"),
    )
    extra = {
        "transaction_amount_eur": F.col("amount_eur"),
        "transaction_country": F.col("transaction_country_code"),
        "rule_triggered_at": F.col("transaction_timestamp"),
        "rule_parameters": F.to_json(parameters),
        "rule_evaluation_details": F.to_json(details),
        "false_positive_flag": F.lit(None).cast("boolean"),
        "investigation_notes": F.lit(None).cast("string"),
        "updated_at": F.lit(None).cast("timestamp"),
    }
    wide = alerts.withColumns(extra).join(context, "customer_id", "left")
    return wide.select(*[F.col(f.name).cast(f.dataType) for f in S.GOLD_ALERTS.fields])


def read_details(alerts: DataFrame, cfg: RuleConfigA) -> DataFrame:
    """Unpack ``rule_evaluation_details`` into one column per flag and measure."""
    fields = [f"{r.flag} boolean" for r in risk.pack_a(cfg)]
    schema = ", ".join([*fields, "rolling_24h_amount decimal(38,2)", "rolling_24h_count bigint"])
    details = F.inline(F.array(F.from_json("rule_evaluation_details", schema)))
    return alerts.select("alert_id", "rule_id", details)


def route_alerts(alerts: DataFrame, severities: tuple[str, ...]) -> DataFrame:
    """Key/value messages of the alerts with one of the given severities."""
    return alerts.filter(F.col("alert_severity").isin(*severities)).select(
        F.col("customer_id").alias("key"), F.to_json(F.struct(*alerts.columns)).alias("value")
    )


# --- rule pack B: six rules, 0..1 score ---------------------------------------------


def add_pack_b_features(df: DataFrame, cfg: RuleConfigB) -> DataFrame:
    """Ratio to the customer's average, listed destination, size and time flags."""
    return df.withColumns(
        {
            "amount_vs_avg_ratio": flags.amount_ratio(F.col("amount"), F.col("avg_transaction_amount")),
            "is_high_risk_country": flags.is_true(
                F.col("destination_country").isin(*cfg.high_risk_countries)
            ),
            "is_large_amount": F.col("amount") > F.lit(cfg.large_cash_amount),
            "is_unusual_time": flags.strictly_after_or_early(
                F.hour("transaction_timestamp"), cfg.unusual_after_hour, cfg.unusual_until_hour
            ),
        }
    )


def large_cash(cfg: RuleConfigB) -> Column:
    return F.col("transaction_type").isin(*cfg.large_cash_types) & (
        F.col("amount") > F.lit(cfg.large_cash_amount)
    )


def high_risk_destination(cfg: RuleConfigB) -> Column:
    return F.col("destination_country").isin(*cfg.high_risk_countries) & (
        F.col("amount") > F.lit(cfg.high_risk_amount)
    )


def unusual_amount(cfg: RuleConfigB) -> Column:
    return F.col("amount_vs_avg_ratio") > cfg.unusual_ratio


def pep_wire(cfg: RuleConfigB) -> Column:
    return (
        F.col("is_pep")
        & (F.col("transaction_type") == "WIRE_TRANSFER")
        & (F.col("amount") > F.lit(cfg.pep_wire_amount))
    )


def high_frequency(cfg: RuleConfigB) -> Column:
    return F.col("rolling_24h_count") > cfg.high_frequency_count


def high_risk_unusual(cfg: RuleConfigB) -> Column:
    return F.col("is_high_risk_country") & F.col("is_unusual_time")


def evaluate_pack_b(df: DataFrame, cfg: RuleConfigB) -> DataFrame:
    """``rule_1_triggered`` .. ``rule_6_triggered`` and how many were raised."""
    predicates = [
        large_cash(cfg),
        high_risk_destination(cfg),
        unusual_amount(cfg),
        pep_wire(cfg),
        high_frequency(cfg),
        high_risk_unusual(cfg),
    ]
    raised = df.withColumns(
        {name: flags.is_true(p) for name, p in zip(PACK_B_FLAGS, predicates, strict=True)}
    )
    return raised.withColumn("total_rules_triggered", risk.rules_raised(PACK_B_FLAGS))


def score_pack_b(df: DataFrame, cfg: RuleConfigB, base_risk: str = "risk_score") -> DataFrame:
    score = F.col("transaction_risk_score")
    return (
        df.withColumn(
            "transaction_risk_score",
            risk.unit_score(F.col("total_rules_triggered"), F.col(base_risk), cfg),
        )
        .withColumn("is_suspicious", score > cfg.suspicious_above)
        .withColumn("alert_priority", risk.priority(score, cfg))
    )


def pack_b_alerts(enriched: DataFrame, generated_at: Column) -> DataFrame:
    """Alert rows of the suspicious transactions, in the declared column order."""
    derived = {
        "alert_generated_at": generated_at,
        "alert_status": F.lit("OPEN"),
        "reviewed_by": F.lit(None),
        "reviewed_at": F.lit(None),
        "processing_date": F.to_date(generated_at),
    }
    return enriched.filter("is_suspicious").select(
        *[
            derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in S.ALERTS.fields
        ]
    )
