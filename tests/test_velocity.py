"""Moving frames against brute force, with hot customers, ties and edges."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerwatch.config import RuleConfigA
from ledgerwatch.operators import velocity

START = datetime(2024, 1, 1)
DAY = timedelta(hours=24)
SCHEMA = "transaction_id string, customer_id string, transaction_timestamp timestamp, amount_eur decimal(18,2)"


def rows(seed: int, n: int = 400):
    """A third of the rows belong to one customer; many share a timestamp."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        customer = "HOT" if i % 3 == 0 else rng.choice(["A", "B", "C", None])
        moment = START + timedelta(minutes=10 * rng.randrange(0, 6 * 24 * 4), microseconds=rng.choice([0, 0, 1, 599_999_999]))
        out.append((f"T{i:05d}", customer, moment, Decimal(rng.randrange(1, 2_000_000)) / 100))
    return out


def brute_force(data):
    expected = {}
    for tid, customer, moment, _ in data:
        frame = [a for _, c, t, a in data if c == customer and moment - DAY <= t <= moment]
        expected[tid] = (sum(frame), len(frame))
    return expected


@pytest.mark.parametrize(("seed", "minutes"), [(1, 10), (2, 60), (3, 1440), (4, 1)])
def test_trailing_frame_equals_brute_force(spark, seed, minutes):
    data = rows(seed)
    df = velocity.trailing_velocity(spark.createDataFrame(data, SCHEMA), RuleConfigA(), minutes)
    got = {r["transaction_id"]: (r["rolling_24h_amount"], r["rolling_24h_count"]) for r in df.collect()}
    assert got == brute_force(data)


def test_frame_includes_exactly_24_hours(spark):
    data = [
        ("T0", "A", START, Decimal("1.00")),
        ("T1", "A", START + DAY, Decimal("2.00")),
        ("T2", "A", START + DAY + timedelta(microseconds=1), Decimal("4.00")),
    ]
    df = velocity.trailing_velocity(spark.createDataFrame(data, SCHEMA), RuleConfigA())
    assert {r["transaction_id"]: r["rolling_24h_amount"] for r in df.collect()} == {
        "T0": Decimal("1.00"),
        "T1": Decimal("3.00"),
        "T2": Decimal("6.00"),
    }


def test_slice_must_divide_the_frame(spark):
    df = spark.createDataFrame(rows(1, 3), SCHEMA)
    with pytest.raises(ValueError, match="divide"):
        velocity.trailing_velocity(df, RuleConfigA(), slice_minutes=7)


def test_wanted_rows_see_the_others(spark):
    data = rows(5)
    df = spark.createDataFrame(data, SCHEMA)
    some = velocity.trailing_velocity(df, RuleConfigA(), wanted=F.col("transaction_id") >= "T00300").collect()
    expected = brute_force(data)
    assert len(some) == 100
    assert all((r["rolling_24h_amount"], r["rolling_24h_count"]) == expected[r["transaction_id"]] for r in some)
    assert all(r["amount_eur"] is not None for r in some)


def test_no_shuffle_gathers_a_customer(spark):
    """Rows and entries are spread by instant or slice; by customer go only slice sums."""
    plan = velocity.trailing_velocity(spark.createDataFrame(rows(6), SCHEMA), RuleConfigA())
    text = plan._jdf.queryExecution().executedPlan().toString()
    alone = [line for line in text.splitlines() if "Exchange hashpartitioning(customer_id" in line and "__" not in line]
    assert len(alone) == 1


def test_copies_of_one_instant_collapse(spark):
    data = [(f"T{i}", "HOT", START, Decimal("0.01")) for i in range(300)] + rows(7, 20)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r["transaction_id"]: (r["rolling_24h_amount"], r["rolling_24h_count"]) for r in velocity.trailing_velocity(df, RuleConfigA()).collect()}
    assert got == brute_force(data)


def test_structuring_counts_only_just_below_the_limit(spark):
    amounts = ["8999.99", "9000.00", "9999.99", "10000.00"]
    data = [(f"T{i}", "A", START + timedelta(hours=i), Decimal(a)) for i, a in enumerate(amounts)]
    df = velocity.trailing_velocity(spark.createDataFrame(data, SCHEMA), RuleConfigA())
    assert [r["structuring_24h_count"] for r in df.orderBy("transaction_id").collect()] == [0, 1, 2, 2]


def test_velocity_anomaly_uses_calendar_days(spark):
    counts = {0: 2, 1: 2, 9: 13}
    data = [
        (f"T{d}-{i}", "A", START + timedelta(days=d, minutes=i), Decimal("1.00"))
        for d, n in counts.items()
        for i in range(n)
    ]
    df = spark.createDataFrame(data, SCHEMA).withColumn("transaction_date", F.to_date("transaction_timestamp"))
    out = {r["daily_count"]: r for r in velocity.daily_velocity(df, RuleConfigA()).orderBy("transaction_date").collect()}
    last = out[13]
    assert last["baseline_daily_count"] == pytest.approx(4 / 9)
    assert last["is_velocity_anomaly"]
    first = velocity.daily_velocity(df, RuleConfigA()).orderBy("transaction_date").first()
    assert first["baseline_daily_count"] is None and not first["is_velocity_anomaly"]


def test_gap_statistics_match_pandas(spark):
    data = rows(8)
    df = spark.createDataFrame(data, SCHEMA).filter("customer_id IS NOT NULL")
    got = {r["customer_id"]: r for r in velocity.gap_statistics(df).collect()}
    local = df.toPandas().sort_values("transaction_timestamp")
    for customer, group in local.groupby("customer_id"):
        gaps = group["transaction_timestamp"].diff().dt.total_seconds().dropna() / 3600
        assert got[customer]["avg_hours_between_transactions"] == pytest.approx(gaps.mean())
        assert got[customer]["stddev_hours_between_transactions"] == pytest.approx(gaps.std())


def test_gap_statistics_of_a_single_transaction(spark):
    df = spark.createDataFrame(rows(1, 1), SCHEMA)
    row = velocity.gap_statistics(df).first()
    assert row["avg_hours_between_transactions"] is None
    assert row["stddev_hours_between_transactions"] is None


def test_time_between_counts_ties_once(spark):
    data = [("T2", "A", START, Decimal("1")), ("T1", "A", START, Decimal("1")), ("T3", "A", START + timedelta(hours=3), Decimal("1"))]
    out = {r["transaction_id"]: r["hours_since_previous"] for r in velocity.time_between(spark.createDataFrame(data, SCHEMA)).collect()}
    assert out == {"T1": None, "T2": 0.0, "T3": 3.0}
