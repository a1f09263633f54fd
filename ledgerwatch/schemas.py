"""Declared table schemas, the message contract, and schema validation."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money": T.DecimalType(18, 2),
    "rate": T.DecimalType(10, 6),
    "score": T.DecimalType(5, 2),
    "share": T.DecimalType(3, 2),
    "ratio4": T.DecimalType(5, 4),
    "ratio2": T.DecimalType(10, 2),
}


def _table(**columns: str) -> T.StructType:
    """One keyword per column; a trailing ``!`` marks a required column."""
    return T.StructType(
        [
            T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!"))
            for name, kind in columns.items()
        ]
    )


# Column names and types of the layered tables and dimensions.
BRONZE_TRANSACTIONS = _table(
    transaction_id="string!",
    transaction_ref="string",
    customer_id="string!",
    account_id="string!",
    amount="string!",
    currency="string!",
    transaction_type="string!",
    channel="string",
    counterparty_account="string",
    counterparty_name="string",
    counterparty_bank="string",
    transaction_country="string",
    transaction_city="string",
    transaction_timestamp="string!",
    value_date="string",
    source_system="string!",
    ingestion_timestamp="timestamp!",
    kafka_partition="int",
    kafka_offset="long",
)

SILVER_TRANSACTIONS = _table(
    transaction_id="string!",
    transaction_ref="string",
    customer_id="string!",
    customer_name="string!",
    customer_risk_category="string!",
    customer_segment="string",
    customer_since_date="date",
    account_id="string!",
    amount="money!",
    amount_eur="money!",
    currency="string!",
    exchange_rate="rate",
    transaction_type="string!",
    channel="string!",
    counterparty_account="string",
    counterparty_name="string",
    counterparty_bank="string",
    counterparty_country="string",
    transaction_country_code="string!",
    transaction_country_name="string!",
    transaction_city="string",
    is_high_risk_country="boolean!",
    transaction_timestamp="timestamp!",
    transaction_date="date!",
    transaction_hour="int!",
    value_date="date",
    is_international="boolean!",
    is_high_value="boolean!",
    is_unusual_time="boolean!",
    business_day_flag="boolean!",
    source_system="string!",
    ingestion_timestamp="timestamp!",
    processing_timestamp="timestamp!",
    data_quality_score="share",
)

GOLD_ALERTS = _table(
    alert_id="string!",
    alert_timestamp="timestamp!",
    alert_date="date!",
    transaction_id="string!",
    customer_id="string!",
    account_id="string!",
    rule_id="string!",
    rule_name="string!",
    rule_category="string!",
    rule_triggered_at="timestamp!",
    risk_score="score!",
    confidence_score="share!",
    alert_severity="string!",
    transaction_amount_eur="money!",
    transaction_country="string!",
    transaction_type="string!",
    customer_risk_category="string!",
    customer_avg_transaction_amount="money",
    customer_transaction_count_30d="int",
    rule_parameters="string",
    rule_evaluation_details="string",
    alert_status="string!",
    false_positive_flag="boolean",
    investigation_notes="string",
    created_at="timestamp!",
    updated_at="timestamp",
)

GOLD_CUSTOMER_DAILY_SUMMARY = _table(
    customer_id="string!",
    summary_date="date!",
    transaction_count="int!",
    total_amount_eur="money!",
    avg_transaction_amount="money!",
    max_transaction_amount="money!",
    min_transaction_amount="money!",
    debit_count="int!",
    credit_count="int!",
    international_count="int!",
    high_risk_country_count="int!",
    atm_count="int!",
    online_count="int!",
    branch_count="int!",
    alert_count="int!",
    high_severity_alert_count="int!",
    computed_at="timestamp!",
)

DIM_CUSTOMER = _table(
    customer_id="string!",
    customer_name="string!",
    customer_risk_category="string!",
    customer_segment="string",
    customer_since_date="date",
    avg_transaction_amount_30d="money",
    transaction_count_30d="int",
    is_pep="boolean!",
    customer_country_code="string",
)

DIM_EXCHANGE_RATES = _table(currency="string!", date="date!", rate_to_eur="rate!")

DIM_HIGH_RISK_COUNTRIES = _table(
    country_code="string!", country_name="string!", risk_level="string!", fatf_listed="boolean!"
)

RAW_TRANSACTIONS = _table(
    transaction_id="string!",
    customer_id="string!",
    transaction_type="string!",
    amount="double!",
    currency="string!",
    source_country="string!",
    destination_country="string!",
    merchant_category="string",
    timestamp="string!",
    channel="string!",
    device_id="string",
    kafka_timestamp="timestamp",
    kafka_partition="int",
    kafka_offset="long",
    processing_timestamp="timestamp",
    processing_date="date!",
)

ALERTS = _table(
    transaction_id="string!",
    customer_id="string!",
    transaction_type="string!",
    amount="double!",
    currency="string!",
    source_country="string!",
    destination_country="string!",
    transaction_timestamp="timestamp!",
    transaction_risk_score="double!",
    alert_priority="string!",
    total_rules_triggered="int!",
    rule_1_triggered="boolean",
    rule_2_triggered="boolean",
    rule_3_triggered="boolean",
    rule_4_triggered="boolean",
    rule_5_triggered="boolean",
    rule_6_triggered="boolean",
    alert_generated_at="timestamp!",
    alert_status="string!",
    reviewed_by="string",
    reviewed_at="timestamp",
    processing_date="date!",
)

CUSTOMER_MASTER = _table(
    customer_id="string!",
    customer_name="string!",
    account_open_date="date!",
    customer_segment="string",
    country_of_residence="string",
    is_pep="boolean",
    kyc_status="string",
    effective_date="timestamp!",
    end_date="timestamp",
    is_current="boolean!",
    created_at="timestamp",
    updated_at="timestamp",
)

DATA_QUALITY_METRICS = _table(
    check_date="date",
    check_timestamp="timestamp",
    table_name="string",
    check_type="string",
    check_name="string",
    check_result="string",
    passed="boolean",
    metric_value="double",
    threshold_value="double",
)

# Message shape of the source/destination model: everything but the time is typed.
GENERATOR_MESSAGE = _table(
    transaction_id="string",
    customer_id="string",
    transaction_type="string",
    amount="double",
    currency="string",
    source_country="string",
    destination_country="string",
    merchant_category="string",
    timestamp="string",
    channel="string",
    device_id="string",
)

SCHEMAS: dict[str, T.StructType] = {
    "bronze_transactions": BRONZE_TRANSACTIONS,
    "silver_transactions": SILVER_TRANSACTIONS,
    "gold_alerts": GOLD_ALERTS,
    "gold_customer_daily_summary": GOLD_CUSTOMER_DAILY_SUMMARY,
    "dim_customer": DIM_CUSTOMER,
    "dim_exchange_rates": DIM_EXCHANGE_RATES,
    "dim_high_risk_countries": DIM_HIGH_RISK_COUNTRIES,
    "raw_transactions": RAW_TRANSACTIONS,
    "alerts": ALERTS,
    "customer_master": CUSTOMER_MASTER,
    "data_quality_metrics": DATA_QUALITY_METRICS,
    "generator_message": GENERATOR_MESSAGE,
}

# Columns of a bronze row that arrive inside the message itself.
MESSAGE_SCHEMA = T.StructType(
    [
        f
        for f in BRONZE_TRANSACTIONS.fields
        if f.name not in ("ingestion_timestamp", "kafka_partition", "kafka_offset")
    ]
)


# The contract an incoming message has to meet.
CONTRACT_REQUIRED = ("transaction_id", "customer_id", "amount", "currency", "timestamp")
CONTRACT_MIN_AMOUNT = "0.01"
CONTRACT_CURRENCY_LENGTH = 3
CONTRACT_TRANSACTION_TYPES = ("DEBIT", "CREDIT")
CONTRACT_CHANNELS = ("ATM", "ONLINE", "BRANCH", "WIRE")


def get_schema(name: str) -> T.StructType:
    if name not in SCHEMAS:
        raise KeyError(f"unknown schema {name!r}; available: {', '.join(sorted(SCHEMAS))}")
    return SCHEMAS[name]


def compare_schema(
    actual: T.StructType, expected: T.StructType
) -> tuple[bool, list[str]]:
    """Missing columns, extra columns and type mismatches, in that order."""
    have = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in expected.fields}
    problems = []
    if missing := sorted(want.keys() - have.keys()):
        problems.append("missing columns: " + ", ".join(missing))
    if extra := sorted(have.keys() - want.keys()):
        problems.append("extra columns: " + ", ".join(extra))
    problems += [
        f"{name}: expected {want[name].simpleString()}, found {have[name].simpleString()}"
        for name in want
        if name in have and have[name] != want[name]
    ]
    return not problems, problems
