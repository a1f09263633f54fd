"""Rule pack B on hand-written rows: the rule, score, priority and time cases."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerwatch.config import RuleConfigB
from ledgerwatch.functions import flags, risk
from ledgerwatch.operators import rules

CFG = RuleConfigB()
NOON = datetime(2024, 1, 15, 12, 0)


def frame(spark, rows):
    """(type, amount, destination, average, pep) rows with pack B features."""
    schema = (
        "transaction_id string, transaction_type string, amount double, destination_country string, "
        "avg_transaction_amount double, is_pep boolean, transaction_timestamp timestamp, rolling_24h_count bigint, "
        "risk_score double"
    )
    full = [(f"T{i}", *row, NOON, 1, None) for i, row in enumerate(rows)]
    return rules.add_pack_b_features(spark.createDataFrame(full, schema), CFG)


def flags_of(df, column):
    return [r[0] for r in df.orderBy("transaction_id").select(column).collect()]


@pytest.mark.parametrize(
    ("column", "rows", "expected"),
    [
        (
            "rule_1_triggered",
            [
                ("CASH_DEPOSIT", 15000.0, "DE", 5000.0, False),
                ("CASH_DEPOSIT", 8000.0, "DE", 5000.0, False),
                ("ATM_WITHDRAWAL", 12000.0, "DE", 5000.0, False),
                ("ONLINE_TRANSFER", 15000.0, "DE", 5000.0, False),
                ("CASH_DEPOSIT", 10000.0, "DE", 5000.0, False),
            ],
            [True, False, True, False, False],
        ),
        (
            "rule_2_triggered",
            [
                ("WIRE_TRANSFER", 6000.0, "AE", 5000.0, False),
                ("WIRE_TRANSFER", 4000.0, "AE", 5000.0, False),
                ("WIRE_TRANSFER", 6000.0, "DE", 5000.0, False),
                ("WIRE_TRANSFER", 6000.0, "RU", 5000.0, False),
                ("WIRE_TRANSFER", 5000.0, "RU", 5000.0, False),
                ("WIRE_TRANSFER", 6000.0, None, 5000.0, False),
            ],
            [True, False, False, True, False, False],
        ),
        (
            "rule_3_triggered",
            [
                ("WIRE_TRANSFER", 30000.0, "DE", 5000.0, False),
                ("WIRE_TRANSFER", 15000.0, "DE", 5000.0, False),
                ("WIRE_TRANSFER", 6000.0, "DE", 5000.0, False),
                ("WIRE_TRANSFER", 6000.0, "DE", None, False),
                ("WIRE_TRANSFER", 25000.0, "DE", 5000.0, False),
                ("WIRE_TRANSFER", 25000.0, "DE", 0.0, False),
            ],
            [True, False, False, False, False, False],
        ),
        (
            "rule_4_triggered",
            [
                ("WIRE_TRANSFER", 60000.0, "DE", 5000.0, True),
                ("WIRE_TRANSFER", 60000.0, "DE", 5000.0, False),
                ("WIRE_TRANSFER", 40000.0, "DE", 5000.0, True),
                ("ONLINE_TRANSFER", 60000.0, "DE", 5000.0, True),
                ("WIRE_TRANSFER", 50000.0, "DE", 5000.0, True),
                ("WIRE_TRANSFER", 60000.0, "DE", 5000.0, None),
            ],
            [True, False, False, False, False, False],
        ),
    ],
)
def test_amount_rules(spark, column, rows, expected):
    assert flags_of(rules.evaluate_pack_b(frame(spark, rows), CFG), column) == expected


def test_three_rules_on_default_base_score_nine_tenths(spark):
    row = [("WIRE_TRANSFER", 60000.0, "AE", 5000.0, True)]
    scored = rules.score_pack_b(rules.evaluate_pack_b(frame(spark, row), CFG), CFG).first()
    assert scored["total_rules_triggered"] == 3
    assert scored["transaction_risk_score"] == 0.9
    assert scored["is_suspicious"]
    assert scored["alert_priority"] == "CRITICAL"


def test_score_is_capped_at_one(spark):
    df = spark.createDataFrame([(6, 0.9)], "total_rules_triggered int, risk_score double")
    assert rules.score_pack_b(df, CFG).first()["transaction_risk_score"] == 1.0


@pytest.mark.parametrize(
    ("score", "label"),
    [
        (0.95, "CRITICAL"),
        (0.9, "CRITICAL"),
        (0.75, "HIGH"),
        (0.7, "HIGH"),
        (0.55, "MEDIUM"),
        (0.5, "MEDIUM"),
        (0.35, "LOW"),
    ],
)
def test_priority(spark, score, label):
    assert spark.range(1).select(risk.priority(F.lit(score), CFG)).first()[0] == label


def test_seven_tenths_is_not_suspicious(spark):
    df = spark.createDataFrame([(2, 0.3)], "total_rules_triggered int, risk_score double")
    assert not rules.score_pack_b(df, CFG).first()["is_suspicious"]


@pytest.mark.parametrize(
    ("moment", "pack_a", "pack_b"),
    [
        (datetime(2024, 1, 15, 3, 0), True, True),
        (datetime(2024, 1, 15, 14, 0), False, False),
        (datetime(2024, 1, 15, 23, 30), True, True),
        (datetime(2024, 1, 15, 22, 15), True, False),
        (datetime(2024, 1, 15, 6, 0), False, False),
    ],
)
def test_unusual_time_differs_at_ten_in_the_evening(spark, moment, pack_a, pack_b):
    hour = F.hour(F.lit(moment))
    row = spark.range(1).select(
        flags.unusual_hour(hour, 22, 6), flags.strictly_after_or_early(hour, 22, 6)
    ).first()
    assert tuple(row) == (pack_a, pack_b)


def test_named_rules_five_and_six(spark):
    df = frame(spark, [("WIRE_TRANSFER", 100.0, "RU", 5000.0, False)] * 2)
    night = df.withColumn("transaction_timestamp", F.lit(datetime(2024, 1, 15, 23, 30)))
    busy = night.withColumn("rolling_24h_count", F.when(F.col("transaction_id") == "T0", 11).otherwise(10))
    out = rules.evaluate_pack_b(rules.add_pack_b_features(busy, CFG), CFG)
    assert flags_of(out, "rule_5_triggered") == [True, False]
    assert flags_of(out, "rule_6_triggered") == [True, True]


def test_alert_rows_follow_the_declared_schema(spark):
    row = [("WIRE_TRANSFER", 60000.0, "AE", 5000.0, True)]
    scored = rules.score_pack_b(rules.evaluate_pack_b(frame(spark, row), CFG), CFG)
    full = scored.withColumns({"customer_id": F.lit("C1"), "currency": F.lit("EUR"), "source_country": F.lit("DE")})
    alert = rules.pack_b_alerts(full, F.lit(NOON)).first()
    assert (alert["alert_status"], alert["processing_date"]) == ("OPEN", NOON.date())
    assert Decimal(str(alert["amount"])) == Decimal("60000.0")
