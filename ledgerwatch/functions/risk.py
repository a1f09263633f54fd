"""Scores, severities and the rule catalogue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ProfileConfig, RuleConfigA, RuleConfigB


@dataclass(frozen=True)
class CatalogueRule:
    rule_id: str
    rule_name: str
    alert_name: str
    rule_category: str
    threshold_value: str | None
    threshold_currency: str | None
    time_window_hours: int | None


# Rule ids, names, categories and thresholds.
RULE_CATALOGUE = (
    CatalogueRule("RULE_HV_001", "High Value Transaction", "High Value Transaction", "VALUE", "10000.00", "EUR", None),
    CatalogueRule("RULE_VEL_001", "Rapid Movement 24h", "Rapid Movement", "VELOCITY", "15000.00", "EUR", 24),
    CatalogueRule("RULE_STR_001", "Structuring Detection", "Structuring Detection", "STRUCTURING", "9000.00", "EUR", 24),
    CatalogueRule("RULE_GEO_001", "High Risk Country", "High Risk Country", "PATTERN", None, None, None),
    CatalogueRule("RULE_PEP_001", "PEP Customer", "PEP Customer", "PATTERN", None, None, None),
    CatalogueRule("RULE_VEL_002", "Unusual Transaction Frequency", "Unusual Transaction Frequency", "VELOCITY", None, None, 24),
    CatalogueRule("RULE_TIME_001", "Unusual Time", "Unusual Time", "PATTERN", None, None, None),
    CatalogueRule("RULE_GEN_001", "General Alert", "General Alert", "PATTERN", None, None, None),
)

PRIORITY_RANK = {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3, "LOW": 4}


def lookup(column: str, mapping: dict[str, str]) -> Column:
    """Constant look-up as one CASE expression, so it stays inside codegen."""
    cases = " ".join(f"WHEN '{key}' THEN '{value}'" for key, value in mapping.items())
    return F.expr(f"CASE {column} {cases} END")


def alert_name(column: str) -> Column:
    return lookup(column, {r.rule_id: r.alert_name for r in RULE_CATALOGUE})


def rule_category(column: str) -> Column:
    return lookup(column, {r.rule_id: r.rule_category for r in RULE_CATALOGUE})


@dataclass(frozen=True)
class FlagRule:
    """How one boolean flag of rule pack A scores and is named."""

    flag: str
    rule_id: str
    points_field: str


# Order is precedence: the first raised flag names the alert.
PACK_A = (
    FlagRule("rule_high_value", "RULE_HV_001", "points_high_value"),
    FlagRule("rule_rapid_movement", "RULE_VEL_001", "points_rapid_movement"),
    FlagRule("rule_high_risk_country", "RULE_GEO_001", "points_high_risk_country"),
    FlagRule("rule_pep_customer", "RULE_PEP_001", "points_pep_customer"),
    FlagRule("rule_unusual_time", "RULE_TIME_001", "points_unusual_time"),
    FlagRule("rule_high_frequency", "RULE_GEN_001", "points_high_frequency"),
)
PACK_A_EXTENDED = (
    FlagRule("rule_structuring", "RULE_STR_001", "points_structuring"),
    FlagRule("rule_velocity_anomaly", "RULE_VEL_002", "points_velocity_anomaly"),
)


def pack_a(cfg: RuleConfigA) -> tuple[FlagRule, ...]:
    """Rules in precedence order; the catch-all stays last."""
    if not cfg.extended:
        return PACK_A
    return PACK_A[:-1] + PACK_A_EXTENDED + PACK_A[-1:]


def points_score(cfg: RuleConfigA) -> Column:
    points = [f"IF({r.flag}, {getattr(cfg, r.points_field)}, 0)" for r in pack_a(cfg)]
    total = " + ".join([str(cfg.base_score), *points])
    if cfg.score_cap is not None:
        total = f"least({total}, {cfg.score_cap})"
    return F.expr(f"CAST({total} AS DECIMAL(5,2))")


def severity(score: Column, cfg: RuleConfigA) -> Column:
    return (
        F.when(score >= cfg.severity_critical, "CRITICAL")
        .when(score >= cfg.severity_high, "HIGH")
        .when(score >= cfg.severity_medium, "MEDIUM")
        .otherwise("LOW")
    )


def primary_rule(cfg: RuleConfigA) -> Column:
    """Id of the first raised rule in precedence order."""
    *named, last = pack_a(cfg)
    cases = " ".join(f"WHEN {r.flag} THEN '{r.rule_id}'" for r in named)
    return F.expr(f"CASE {cases} ELSE '{last.rule_id}' END")


def raised_rules(cfg: RuleConfigA) -> Column:
    """Ids of every raised rule."""
    ids = ", ".join(f"IF({r.flag}, '{r.rule_id}', NULL)" for r in pack_a(cfg))
    return F.expr(f"array_compact(array({ids}))")


def rules_raised(flags: list[str]) -> Column:
    return F.expr(" + ".join(f"CAST(coalesce({flag}, FALSE) AS INT)" for flag in flags))


def unit_score(n_rules: Column, base_risk: Column, cfg: RuleConfigB) -> Column:
    """Step per raised rule on top of the customer's base risk, at most 1.

    Rounded to 4 places so that 3 * 0.2 + 0.3 is exactly comparable with 0.9.
    """
    raw = n_rules * F.lit(cfg.score_step) + F.coalesce(base_risk, F.lit(cfg.default_base_risk))
    return F.least(F.lit(1.0), F.round(raw, 4))


def priority(score: Column, cfg: RuleConfigB) -> Column:
    return (
        F.when(score >= cfg.priority_critical, "CRITICAL")
        .when(score >= cfg.priority_high, "HIGH")
        .when(score >= cfg.priority_medium, "MEDIUM")
        .otherwise("LOW")
    )


def priority_rank(label: Column) -> Column:
    """1 for CRITICAL down to 4, so that a minimum is the highest priority."""
    return (
        F.when(label == "CRITICAL", 1).when(label == "HIGH", 2).when(label == "MEDIUM", 3).otherwise(4)
    )


def priority_label(rank: Column) -> Column:
    return F.when(rank == 1, "CRITICAL").when(rank == 2, "HIGH").when(rank == 3, "MEDIUM").otherwise("LOW")


def profile_category(cfg: ProfileConfig) -> Column:
    high = (
        (F.col("high_value_ratio") > cfg.high_hv_ratio)
        | (F.col("high_risk_country_count_90d") > cfg.high_country_count)
        | (F.col("avg_transaction_amount_90d") > cfg.high_avg_amount)
    )
    medium = (F.col("high_value_ratio") > cfg.medium_hv_ratio) | (
        F.col("international_ratio") > cfg.medium_intl_ratio
    )
    return F.when(high, "HIGH").when(medium, "MEDIUM").otherwise("LOW")
