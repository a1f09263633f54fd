from __future__ import annotations

from datetime import date, datetime

from ledgerwatch.operators import reports
from ledgerwatch.operators import warehouse as ops
from ledgerwatch.plans.catalog import warehouse
from ledgerwatch.plans.catalog.inputs import Inputs


def test_every_customer_is_in_the_dimension(spark, small):
    x = Inputs(spark, small)
    everyone = {r.customer_id for r in x.master.collect()}
    assert {r.customer_id for r in warehouse.customers(x).collect()} == everyone
    high = {r.customer_id for r in warehouse.high_risk_customers(x).collect()}
    assert {c for c in everyone if int(c[1:]) % 3 == 0 or int(c[1:]) % 4 == 0} == high
    assert any(int(c[1:]) % 50 == 49 for c in high)


def test_an_account_known_from_broken_times_only_is_kept(spark, small):
    x = Inputs(spark, small)
    rows = [("A1", "C1", "not a time"), ("A2", "C1", "not a time"), ("A2", "C1", "2024-01-05 10:00:00.000000"), ("A2", "C1", "2024-01-03 23:59:59.000000")]
    x.__dict__["bronze"] = spark.createDataFrame(rows, "account_id string, customer_id string, transaction_timestamp string")
    opened = {r.account_id: r.account_open_date for r in warehouse.dim_account(x).collect()}
    assert {k: str(v) for k, v in opened.items()} == {"A1": "None", "A2": "2024-01-03"}


def test_current_risk_is_that_of_the_current_version(spark):
    versions = [("A", 1, date(2023, 1, 1), False, 0.1, "LOW"), ("A", 2, date(2024, 1, 1), True, 0.9, "HIGH"), ("B", 3, date(2023, 1, 1), False, 0.5, "MEDIUM")]
    customers = spark.createDataFrame(versions, "customer_id string, customer_sk long, effective_date date, is_current boolean, risk_score double, risk_category string")
    metrics = spark.createDataFrame([(1, 20230101), (1, 20230102), (2, 20240101), (3, 20230101), (-1, 20230101)], "customer_sk long, metric_date_sk int")
    out = sorted(map(tuple, ops.with_current_risk(metrics, customers).collect()))
    assert out == [
        (-1, 20230101, None, None), (1, 20230101, 0.9, "HIGH"), (1, 20230102, 0.9, "HIGH"), (2, 20240101, 0.9, "HIGH"), (3, 20230101, None, None)
    ]


def test_broker_time_is_carried_into_alert_details(spark):
    alerts = spark.createDataFrame([("t1", "A")], "transaction_id string, customer_id string")
    moved = "transaction_id string, merchant_category string, channel string, device_id string, amount_vs_avg_ratio double"
    profile = (
        "customer_id string, customer_name string, customer_segment string, risk_category string, account_age_days int, "
        "country_of_residence string, kyc_status string, is_current boolean"
    )
    profiles = spark.createDataFrame([], profile)
    row = ("t1", "M", "WEB", "D", 1.0)
    with_time = spark.createDataFrame([(*row, datetime(2024, 1, 1))], f"{moved}, kafka_timestamp timestamp")
    assert reports.enrich_alerts(alerts, with_time, profiles).first()["kafka_timestamp"] == datetime(2024, 1, 1)
    assert "kafka_timestamp" not in reports.enrich_alerts(alerts, spark.createDataFrame([row], moved), profiles).columns
