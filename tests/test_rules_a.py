"""Rule pack A: limits, points, severity, precedence and naming."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from decimal import Decimal
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from ledgerwatch.config import RuleConfigA
from ledgerwatch.functions import risk
from ledgerwatch.operators import rules

CFG = RuleConfigA()
BASE = {
    "transaction_id": "T1",
    "amount_eur": Decimal("1.00"),
    "is_high_risk_country": False,
    "is_unusual_time": False,
    "is_pep": False,
    "rolling_24h_amount": Decimal("1.00"),
    "rolling_24h_count": 1,
    "structuring_24h_count": 0,
    "is_velocity_anomaly": False,
}
SCHEMA = (
    "transaction_id string, amount_eur decimal(18,2), is_high_risk_country boolean, is_unusual_time boolean, "
    "is_pep boolean, rolling_24h_amount decimal(38,2), rolling_24h_count bigint, structuring_24h_count bigint, "
    "is_velocity_anomaly boolean"
)
ALL = {
    "amount_eur": Decimal("10000.01"),
    "is_high_risk_country": True,
    "is_unusual_time": True,
    "is_pep": True,
    "rolling_24h_amount": Decimal("15000.01"),
    "rolling_24h_count": 11,
}


def one(spark, **values):
    return spark.createDataFrame([{**BASE, **values}], SCHEMA)


@pytest.mark.parametrize(
    ("flag", "values", "expected"),
    [
        ("rule_high_value", {"amount_eur": Decimal("10000.00")}, False),
        ("rule_high_value", {"amount_eur": Decimal("10000.01")}, True),
        ("rule_rapid_movement", {"rolling_24h_amount": Decimal("15000.00")}, False),
        ("rule_rapid_movement", {"rolling_24h_amount": Decimal("15000.01")}, True),
        ("rule_high_frequency", {"rolling_24h_count": 10}, False),
        ("rule_high_frequency", {"rolling_24h_count": 11}, True),
        ("rule_pep_customer", {"is_pep": None}, False),
        ("rule_pep_customer", {"is_pep": True}, True),
        ("rule_high_risk_country", {"is_high_risk_country": None}, False),
        ("rule_unusual_time", {"is_unusual_time": True}, True),
    ],
)
def test_limits(spark, flag, values, expected):
    assert rules.evaluate_pack_a(one(spark, **values), CFG).first()[flag] is expected


def test_no_rule_no_alert(spark):
    assert rules.raise_alerts(one(spark), CFG, F.lit(datetime(2024, 1, 1))).count() == 0


def test_all_rules_score_125_unless_capped(spark):
    raised = rules.evaluate_pack_a(one(spark, **ALL), CFG)
    assert rules.score_pack_a(raised, CFG).first()["risk_score"] == Decimal("125.00")
    assert rules.score_pack_a(raised, replace(CFG, score_cap=100)).first()["risk_score"] == Decimal("100.00")
    based = replace(CFG, base_score=50)
    assert rules.score_pack_a(rules.evaluate_pack_a(one(spark), based), based).first()["risk_score"] == Decimal("50.00")


@pytest.mark.parametrize(
    ("score", "label"),
    [(75, "CRITICAL"), (74, "HIGH"), (50, "HIGH"), (49, "MEDIUM"), (25, "MEDIUM"), (24, "LOW")],
)
def test_severity(spark, score, label):
    assert spark.range(1).select(risk.severity(F.lit(score), CFG)).first()[0] == label


@pytest.mark.parametrize(
    ("raised", "rule_id"),
    [
        (("amount_eur", "rolling_24h_amount", "is_pep"), "RULE_HV_001"),
        (("rolling_24h_amount", "is_high_risk_country"), "RULE_VEL_001"),
        (("is_high_risk_country", "is_pep"), "RULE_GEO_001"),
        (("is_pep", "is_unusual_time"), "RULE_PEP_001"),
        (("is_unusual_time", "rolling_24h_count"), "RULE_TIME_001"),
        (("rolling_24h_count",), "RULE_GEN_001"),
    ],
)
def test_precedence_and_alert_id(spark, raised, rule_id):
    row = one(spark, **{name: ALL[name] for name in raised})
    alert = rules.raise_alerts(row, CFG, F.lit(datetime(2024, 1, 1))).first()
    assert alert["rule_id"] == rule_id
    assert alert["alert_id"] == sha256(f"T1|{rule_id}".encode()).hexdigest()


def test_one_alert_per_raised_rule(spark):
    alerts = rules.raise_alerts(one(spark, **ALL), CFG, F.lit(datetime(2024, 1, 1)), per_rule=True)
    assert alerts.count() == alerts.select("alert_id").distinct().count() == 6


def test_extended_rules(spark):
    cfg = replace(CFG, extended=True)
    row = one(spark, structuring_24h_count=3, is_velocity_anomaly=True)
    ids = {
        r["rule_id"]
        for r in rules.raise_alerts(row, cfg, F.lit(datetime(2024, 1, 1)), per_rule=True).collect()
    }
    assert ids == {"RULE_STR_001", "RULE_VEL_002"}
    assert rules.evaluate_pack_a(one(spark, structuring_24h_count=2), cfg).first()["rule_structuring"] is False


def test_every_rule_has_a_name_and_category(spark):
    ids = [r.rule_id for r in risk.RULE_CATALOGUE]
    df = spark.createDataFrame([(i,) for i in ids], "rule_id string")
    named = df.select(risk.alert_name("rule_id").alias("n"), risk.rule_category("rule_id").alias("c"))
    assert named.filter("n IS NULL OR c IS NULL").count() == 0
