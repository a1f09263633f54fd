"""Messages, typing, duplicates, look-ups and the silver layout."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerwatch import schemas
from ledgerwatch.config import RuleConfigA
from ledgerwatch.functions import flags
from ledgerwatch.operators import enrich, grouping, ingest
from ledgerwatch.plans.alerting import build_silver
from ledgerwatch.plans.catalog.inputs import Inputs

GOOD = '{"transaction_id":"T1","customer_id":"C1","amount":"12.50","currency":"EUR","transaction_type":"DEBIT","channel":"ATM","transaction_timestamp":"2024-01-01 10:00:00"}'


def messages(spark, *values):
    rows = [(v, i, i * 10, datetime(2024, 1, 1)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value string, partition int, offset int, timestamp timestamp")


def test_parse_keeps_metadata_and_survives_bad_json(spark):
    parsed = ingest.parse_messages(messages(spark, GOOD, "{oops"), ingested_at=F.lit(datetime(2024, 1, 2)))
    good, bad = parsed.orderBy("kafka_partition").collect()
    assert (good["transaction_id"], good["kafka_offset"], good["ingestion_date"]) == ("T1", 0, date(2024, 1, 2))
    assert bad["transaction_id"] is None and bad["kafka_offset"] == 10


@pytest.mark.parametrize(
    ("change", "clause"),
    [
        ({"customer_id": None}, "missing_customer_id"),
        ({"amount": "abc"}, "amount_not_numeric"),
        ({"amount": "0.00"}, "amount_below_minimum"),
        ({"currency": "EURO"}, "currency_length"),
        ({"transaction_type": "GIFT"}, "transaction_type_enum"),
        ({"channel": "FAX"}, "channel_enum"),
        ({"transaction_timestamp": "yesterday"}, "timestamp_format"),
        ({}, None),
        ({"channel": None, "amount": "0.01"}, None),
    ],
)
def test_contract(spark, change, clause):
    row = {
        "transaction_id": "T1",
        "customer_id": "C1",
        "amount": "5.00",
        "currency": "EUR",
        "transaction_type": "DEBIT",
        "channel": "ATM",
        "transaction_timestamp": "2024-01-01 10:00:00",
    } | change
    df = spark.createDataFrame([row], ", ".join(f"{k} string" for k in row))
    assert ingest.contract_violations(df).first()["violations"] == ([clause] if clause else [])


def typed(spark, rows, **options):
    df = spark.createDataFrame(rows, "transaction_id string, amount string, transaction_timestamp string")
    return {r["transaction_id"]: r["amount"] for r in ingest.type_and_reject(df, **options).collect()}


def test_typing_policies(spark):
    rows = [("a", "1.005", "2024-01-01 00:00:00"), ("b", "x", "2024-01-01T00:00:00"), ("c", "-1", "2024-01-01 00:00:00"), ("d", "1", "?")]
    assert typed(spark, rows) == {"a": Decimal("1.01")}
    assert typed(spark, rows, on_bad_amount="zero") == {"a": Decimal("1.01"), "b": Decimal("0.00")}
    assert typed(spark, [("a", "1", "01/02/2024")], time_format="dd/MM/yyyy") == {"a": Decimal("1.00")}


def test_keep_latest_limits_copies_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS v")
    out = grouping.keep_latest(df, ["k"], [F.col("v").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert out.filter("k = 0").first()["v"] == 999


def test_missing_rate_is_flagged_and_kept(spark):
    df = spark.createDataFrame([("EUR", Decimal("3.00")), ("XXX", Decimal("3.00"))], "currency string, amount decimal(18,2)")
    rates = spark.createDataFrame([("EUR", Decimal("2.000000"))], "currency string, rate_to_eur decimal(10,6)")
    out = {r["currency"]: (r["amount_eur"], r["fx_missing"]) for r in enrich.attach_rate(df, rates).collect()}
    assert out == {"EUR": (Decimal("6.00"), False), "XXX": (Decimal("3.00"), True)}


def test_conversion_rounds_half_up(spark):
    df = spark.createDataFrame([("JPY", Decimal("2.50"))], "currency string, amount decimal(18,2)")
    rates = spark.createDataFrame([("JPY", Decimal("0.006000"))], "currency string, rate_to_eur decimal(10,6)")
    assert enrich.attach_rate(df, rates).first()["amount_eur"] == Decimal("0.02")


def test_as_of_rate(spark):
    rates = spark.createDataFrame(
        [("USD", date(2024, 1, 3), Decimal("1")), ("USD", date(2024, 1, 6), Decimal("2"))],
        "currency string, date date, rate_to_eur decimal(10,6)",
    )
    days = [date(2024, 1, d) for d in (2, 3, 5, 6, 30)]
    df = spark.createDataFrame([("USD", d, Decimal("1.00")) for d in days], "currency string, transaction_date date, amount decimal(18,2)")
    out = enrich.attach_rate_as_of(df, rates).orderBy("transaction_date").collect()
    assert [None if r["exchange_rate"] is None else int(r["exchange_rate"]) for r in out] == [None, 1, 1, 2, 2]


def test_recent_only_is_inclusive(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 24),), (datetime(2024, 1, 23, 23, 59, 59),)], "transaction_timestamp timestamp")
    assert ingest.recent_only(df, F.lit(datetime(2024, 1, 31))).count() == 1


def test_quality_share_counts_real_columns(spark):
    df = spark.createDataFrame([(None, None, None)], "a string, b string, c string")
    assert df.select(flags.null_share_score(["a", "b", "c"])).first()[0] == Decimal("0.00")


def test_silver_layout(spark, small):
    x = Inputs(spark, small)
    silver = enrich.to_silver(build_silver(x.bronze, x.dimensions, RuleConfigA()), F.lit(datetime(2024, 1, 31)))
    ok, problems = schemas.compare_schema(silver.schema, schemas.SILVER_TRANSACTIONS)
    assert ok, problems
    assert silver.columns == schemas.SILVER_TRANSACTIONS.fieldNames()


def test_schema_registry_and_comparison(spark):
    with pytest.raises(KeyError, match="silver_transactions"):
        schemas.get_schema("nope")
    df = spark.createDataFrame([(1, "x")], "currency int, extra string")
    ok, problems = schemas.compare_schema(df.schema, schemas.get_schema("dim_exchange_rates"))
    assert not ok
    assert problems == ["missing columns: date, rate_to_eur", "extra columns: extra", "currency: expected string, found int"]


def test_as_of_rate_after_the_newest_rate(spark):
    rates = spark.createDataFrame([("USD", date(2024, 1, 3), Decimal("1")), ("USD", date(2024, 2, 20), Decimal("0.5"))], "currency string, date date, rate_to_eur decimal(10,6)")
    df = spark.createDataFrame([("USD", date(2024, 3, 1), Decimal("1.00"))], "currency string, transaction_date date, amount decimal(18,2)")
    row = enrich.attach_rate_as_of(df, rates).first()
    assert (row["amount_eur"], row["fx_missing"]) == (Decimal("0.50"), False)


def test_first_copies_keep_rows_without_an_id(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), (None, 1, "p"), (None, 1, "q")]
    got = ingest.first_copies(spark.createDataFrame(rows, "transaction_id string, ingestion_timestamp int, v string"))
    assert sorted((str(r.transaction_id), r.v) for r in got.collect()) == [("None", "p"), ("None", "q"), ("a", "y")]
