"""Checks, suites, gate and service levels."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerwatch.config import QualityConfig
from ledgerwatch.operators import quality

CFG = QualityConfig()


def results(df):
    return {(r["check_type"], r["check_name"]): r for r in df.collect()}


def test_null_conditions_are_not_invalid_and_null_keys_count_once(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, -1), (None, 5)], "id string, v int")
    checks = quality.completeness(("id",)) + quality.validity({"positive": F.col("v") > 0}) + quality.uniqueness(("id",))
    out = results(quality.run_checks(df, "t", checks))
    assert out["COMPLETENESS", "id"]["metric_value"] == 2 and out["COMPLETENESS", "id"]["metric_percent"] == 50.0
    assert out["VALIDITY", "positive"]["metric_value"] == 1
    assert out["UNIQUENESS", "id"]["metric_value"] == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "id string, at timestamp")
    checks = quality.completeness(("id",)) + quality.uniqueness(("id",)) + quality.timeliness("at", F.lit(datetime(2024, 1, 1)), CFG)
    out = results(quality.run_checks(df, "t", checks))
    assert set(out) == {("COMPLETENESS", "id"), ("UNIQUENESS", "id")}
    assert all(r["passed"] for r in out.values())
    assert quality.completeness_score(df, ["id"]).first()["completeness"] == 0.0


@pytest.mark.parametrize(("hour", "passed"), [(1, True), (0, False)])
def test_freshness_is_under_24_hours(spark, hour, passed):
    df = spark.createDataFrame([(datetime(2024, 1, 1, hour),)], "at timestamp")
    out = quality.run_checks(df, "t", quality.timeliness("at", F.lit(datetime(2024, 1, 2)), CFG)).first()
    assert out["passed"] is passed


def test_consistency_checks_only_present_columns():
    assert [c.name for c in quality.consistency(["amount"])] == ["positive_amounts"]
    assert quality.consistency(["x"]) == []


@pytest.mark.parametrize(("passed", "status"), [(19, "PASS"), (18, "FAIL")])
def test_overall_pass_mark_and_gate(spark, passed, status):
    checks = spark.createDataFrame([(i < passed,) for i in range(20)], "passed boolean")
    summary = quality.overall(checks, CFG)
    assert summary.first()["overall_status"] == status
    if status == "PASS":
        quality.gate(summary)
    else:
        with pytest.raises(quality.QualityGateError, match="90.0"):
            quality.gate(summary)


def test_suite_is_one_aggregate(spark):
    df = spark.createDataFrame([("a", "b", 1.0, "EUR", "x", "CASH_DEPOSIT")], "transaction_id string, customer_id string, amount double, currency string, timestamp string, transaction_type string")
    plan = quality.raw_suite(df, CFG)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_volume_gate(spark):
    assert quality.has_at_least(spark.range(10), 10)
    assert not quality.has_at_least(spark.range(9), 10)


def test_hot_orphan_key_is_one_row_in_the_join(spark):
    child = spark.range(90).selectExpr("CASE WHEN id % 3 = 0 THEN 'gone' ELSE 'here' END AS k")
    parent = spark.createDataFrame([("here",)], "k string")
    assert tuple(quality.referential_integrity(child, parent, "k").first()) == (1, 30)


def test_reconcile_reports_one_sided_keys(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, amount int")
    right = spark.createDataFrame([("a", 1), ("c", 5)], "k string, amount int")
    out = {r["k"]: (r["row_difference"], int(r["amount_difference"]), r["reconciled"]) for r in quality.reconcile(left, right, ["k"], "amount").collect()}
    assert out == {"a": (0, 0, True), "b": (1, 2, False), "c": (-1, -5, False)}


def test_reconcile_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, amount int")
    right = spark.createDataFrame([(None, 1), ("a", 3)], "k string, amount int")
    rows = {r.k: r.reconciled for r in quality.reconcile(left, right, ["k"], "amount").collect()}
    assert rows == {None: True, "a": False}
