"""Parsing, validation, typing and enrichment."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...config import RuleConfigA
from ...functions import flags
from ...operators import enrich
from ...operators import ingest as ops
from ...session import run_dir
from ...sources import tables
from .. import alerting
from .base import Entry
from .inputs import (
    CUSTOMERS_SQL,
    EVENTS_SQL,
    RATES_SQL,
    RAW_SQL,
    SILVER_SQL,
    TYPED_SQL,
    Inputs,
)

RULES = RuleConfigA()
AS_OF = datetime(2024, 1, 31)


def parse_messages(x: Inputs) -> DataFrame:
    return ops.parse_messages(x.messages, ingested_at=F.lit(AS_OF)).select(
        "transaction_id",
        "customer_id",
        "amount",
        "currency",
        "transaction_type",
        "channel",
        "transaction_timestamp",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "ingestion_date",
    )


_BRONZE_FIELDS = """
  SELECT event_id, ts, transaction_id, customer_id,
         CASE WHEN event_id % 97 = 0 THEN 'n/a' WHEN event_id % 89 = 0 THEN '-' || CAST(amount AS VARCHAR)
              ELSE CAST(amount AS VARCHAR) END AS amount,
         list_extract(['EUR','USD','GBP','CHF','JPY','AED'], CAST(event_id % 6 AS INTEGER) + 1) AS currency,
         CASE WHEN event_id % 2 = 0 THEN 'DEBIT' ELSE 'CREDIT' END AS transaction_type,
         CASE WHEN event_id % 107 <> 0
              THEN list_extract(['ATM','ONLINE','BRANCH','WIRE'], CAST(event_id % 4 AS INTEGER) + 1) END AS channel,
         CASE WHEN event_id % 101 = 0 THEN 'not a time'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS transaction_timestamp,
         event_id % 103 = 0 AS broken
  FROM ev"""

PARSE_SQL = f"""WITH {EVENTS_SQL}, b AS ({_BRONZE_FIELDS})
SELECT CASE WHEN NOT broken THEN transaction_id END AS transaction_id,
       CASE WHEN NOT broken THEN customer_id END AS customer_id,
       CASE WHEN NOT broken THEN amount END AS amount,
       CASE WHEN NOT broken THEN currency END AS currency,
       CASE WHEN NOT broken THEN transaction_type END AS transaction_type,
       CASE WHEN NOT broken THEN channel END AS channel,
       CASE WHEN NOT broken THEN transaction_timestamp END AS transaction_timestamp,
       CAST(event_id % 12 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
       ts + to_seconds(event_id % 5) AS kafka_timestamp, DATE '2024-01-31' AS ingestion_date
FROM b"""


def contract_violations(x: Inputs) -> DataFrame:
    parsed = ops.parse_messages(x.messages, ingested_at=F.lit(AS_OF))
    return (
        ops.split_quarantine(ops.contract_violations(parsed))[1]
        .select("kafka_offset", F.array_join("violations", ",").alias("violations"))
    )


VIOLATIONS_SQL = f"""WITH {EVENTS_SQL}, b AS ({_BRONZE_FIELDS}),
v AS (SELECT event_id AS kafka_offset,
  CASE WHEN broken THEN 'missing_transaction_id,missing_customer_id,missing_amount,missing_currency,missing_timestamp'
       ELSE concat_ws(',', CASE WHEN amount = 'n/a' THEN 'amount_not_numeric' END,
                      CASE WHEN TRY_CAST(amount AS DECIMAL(18,2)) < 0.01 THEN 'amount_below_minimum' END,
                      CASE WHEN transaction_timestamp = 'not a time' THEN 'timestamp_format' END) END AS violations
  FROM b)
SELECT kafka_offset, violations FROM v WHERE violations <> ''"""


def generator_bronze(x: Inputs) -> DataFrame:
    messages = x.raw.withColumn("timestamp", F.date_format("transaction_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    mapped = ops.generator_to_bronze(messages, "STREAM")
    return ops.type_and_reject(mapped).select(
        "transaction_id",
        "customer_id",
        "account_id",
        "amount",
        "currency",
        "transaction_type",
        "channel",
        "transaction_country",
        "transaction_timestamp",
        "source_system",
    )


GENERATOR_SQL = f"""WITH {RAW_SQL}
SELECT transaction_id, customer_id, 'UNKNOWN' AS account_id, amount, currency,
       CASE WHEN transaction_type IN ('CASH_DEPOSIT','CHECK_DEPOSIT') THEN 'CREDIT' ELSE 'DEBIT' END AS transaction_type,
       channel, destination_country AS transaction_country, transaction_timestamp, 'STREAM' AS source_system
FROM raw WHERE amount > 0"""


def cast_and_reject(x: Inputs) -> DataFrame:
    return ops.type_and_reject(x.bronze).select(
        "transaction_id", "amount", "transaction_timestamp", "channel", "transaction_country"
    )


CAST_SQL = f"""WITH {TYPED_SQL}
SELECT transaction_id, amount, transaction_timestamp, channel, transaction_country FROM tx"""


def zero_bad_amounts(x: Inputs) -> DataFrame:
    return ops.type_and_reject(x.bronze, on_bad_amount="zero").select("transaction_id", "amount")


ZERO_SQL = f"""WITH {EVENTS_SQL}
SELECT transaction_id, CASE WHEN event_id % 97 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE amount END AS amount
FROM ev WHERE (event_id % 97 = 0 OR event_id % 89 <> 0) AND event_id % 101 <> 0"""


def recent_transactions(x: Inputs) -> DataFrame:
    typed = ops.type_and_reject(x.bronze)
    return ops.recent_only(typed, F.lit(AS_OF)).select("transaction_id", "transaction_timestamp")


RECENT_SQL = f"""WITH {TYPED_SQL}
SELECT transaction_id, transaction_timestamp FROM tx WHERE transaction_timestamp >= TIMESTAMP '2024-01-24'"""


def latest_copies(x: Inputs) -> DataFrame:
    """Every event appears once per copy; a third of all rows share one id."""
    i = F.substring("transaction_id", 4, 10).cast("bigint")
    collapsed = F.when(i % 3 == 0, F.lit("TXN0000000000")).otherwise(F.col("transaction_id"))
    copies = ops.type_and_reject(x.bronze).withColumns({"transaction_id": collapsed, "version": i})
    unique = ops.deduplicate(copies, order_by="version")
    return unique.select("transaction_id", "version", "amount")


LATEST_SQL = f"""WITH {TYPED_SQL},
c AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'TXN0000000000' ELSE transaction_id END AS transaction_id,
             event_id AS version, amount FROM tx)
SELECT transaction_id, max(version) AS version, arg_max(amount, version) AS amount FROM c GROUP BY transaction_id"""


def fx_convert(x: Inputs) -> DataFrame:
    return alerting.typed_amounts(x.bronze, x.dimensions).select(
        "transaction_id", "currency", "amount", "exchange_rate", "amount_eur", "fx_missing"
    )


FX_SQL = f"""WITH {SILVER_SQL}
SELECT transaction_id, currency, amount, exchange_rate, amount_eur, fx_missing FROM sv"""


def _dated_rates(x: Inputs) -> DataFrame:
    """Weekly rates per currency, from the average amount of each week's transactions."""
    week = F.to_date(F.date_trunc("week", "ts")).alias("date")
    priced = x.events.select(
        F.element_at(F.array(*[F.lit(c) for c in ("EUR", "USD", "GBP", "CHF", "JPY", "AED")]),
                     (F.col("event_id") % 6).cast("int") + 1).alias("currency"),
        week,
    )
    return (
        priced.filter("currency <> 'AED'")
        .groupBy("currency", "date")
        .agg(F.count("*").alias("n"))
        .filter((F.col("n") + F.dayofmonth("date")) % 3 != 0)
        .select("currency", "date", (F.lit(0.5).cast("decimal(10,6)") + (F.col("n") % 100).cast("decimal(10,6)") / 100).cast("decimal(10,6)").alias("rate_to_eur"))
    )


_RATES_SQL = """
weekly AS (
  SELECT list_extract(['EUR','USD','GBP','CHF','JPY','AED'], CAST(event_id % 6 AS INTEGER) + 1) AS currency,
         CAST(date_trunc('week', ts) AS DATE) AS date, count(*) AS n
  FROM events GROUP BY 1, 2),
dated AS (
  SELECT currency, date, CAST(0.5 + CAST(n % 100 AS DECIMAL(10,6)) / 100 AS DECIMAL(10,6)) AS rate
  FROM weekly WHERE currency <> 'AED' AND (n + day(date)) % 3 <> 0)"""


def fx_dated(x: Inputs) -> DataFrame:
    typed = enrich.add_calendar(ops.type_and_reject(x.bronze))
    return enrich.attach_dated_rate(typed, _dated_rates(x)).select(
        "transaction_id", "exchange_rate", "amount_eur", "fx_missing"
    )


FX_DATED_SQL = f"""WITH {TYPED_SQL},{_RATES_SQL}
SELECT transaction_id, rate AS exchange_rate,
       CAST(round(coalesce(amount * rate, amount), 2) AS DECIMAL(18,2)) AS amount_eur, rate IS NULL AS fx_missing
FROM tx LEFT JOIN dated ON dated.currency = tx.currency AND dated.date = tx.transaction_date"""


def fx_as_of(x: Inputs) -> DataFrame:
    typed = enrich.add_calendar(ops.type_and_reject(x.bronze))
    return enrich.attach_rate_as_of(typed, _dated_rates(x)).select(
        "transaction_id", "exchange_rate", "amount_eur", "fx_missing"
    )


FX_AS_OF_SQL = f"""WITH {TYPED_SQL},{_RATES_SQL}
SELECT transaction_id, rate AS exchange_rate,
       CAST(round(coalesce(amount * rate, amount), 2) AS DECIMAL(18,2)) AS amount_eur, rate IS NULL AS fx_missing
FROM tx ASOF LEFT JOIN dated ON dated.currency = tx.currency AND tx.transaction_date >= dated.date"""


def customer_enrich(x: Inputs) -> DataFrame:
    return enrich.attach_customer(ops.type_and_reject(x.bronze), x.customers).select(
        "transaction_id", "customer_id", "customer_name", "customer_risk_category", "customer_segment", "is_pep"
    )


CUSTOMER_SQL = f"""WITH {SILVER_SQL}
SELECT transaction_id, customer_id, customer_name, customer_risk_category, customer_segment, is_pep FROM sv"""


def customer_enrich_strict(x: Inputs) -> DataFrame:
    known = enrich.attach_customer(ops.type_and_reject(x.bronze), x.customers, strict=True)
    return known.select("transaction_id", "customer_id", "customer_name")


STRICT_SQL = f"""WITH {TYPED_SQL},{CUSTOMERS_SQL}
SELECT transaction_id, customer_id, customer_name FROM tx JOIN customers USING (customer_id)"""


def unknown_customer_rows(x: Inputs) -> DataFrame:
    return enrich.unknown_customers(ops.type_and_reject(x.bronze), x.customers).select(
        "transaction_id", "customer_id"
    )


UNKNOWN_SQL = f"""WITH {TYPED_SQL},{CUSTOMERS_SQL}
SELECT transaction_id, customer_id FROM tx ANTI JOIN customers USING (customer_id)"""


def country_risk(x: Inputs) -> DataFrame:
    dims = x.dimensions
    located = enrich.attach_country(ops.type_and_reject(x.bronze), dims.risk_countries, dims.countries)
    return located.select(
        "transaction_id", "transaction_country_code", "transaction_country_name", "is_high_risk_country"
    )


COUNTRY_SQL = f"""WITH {SILVER_SQL}
SELECT transaction_id, transaction_country_code, transaction_country_name, is_high_risk_country FROM sv"""


def date_flags(x: Inputs) -> DataFrame:
    return alerting.build_silver(x.bronze, x.dimensions, RULES).select(
        "transaction_id",
        "transaction_date",
        "transaction_hour",
        "is_unusual_time",
        "business_day_flag",
        "is_high_value",
        "is_international",
    )


FLAGS_SQL = f"""WITH {SILVER_SQL}
SELECT transaction_id, transaction_date, transaction_hour, is_unusual_time, business_day_flag,
       is_high_value, is_international FROM sv"""


def silver_full(x: Inputs) -> DataFrame:
    silver = alerting.build_silver(x.bronze, x.dimensions, RULES)
    return enrich.to_silver(silver, F.lit(AS_OF))


SILVER_FULL_SQL = f"""WITH {SILVER_SQL},
full_rows AS (
SELECT transaction_id, 'REF' || lpad(CAST(event_id AS VARCHAR), 8, '0') AS transaction_ref, customer_id,
       customer_name, customer_risk_category, customer_segment, customer_since_date, account_id, amount,
       amount_eur, currency, exchange_rate, transaction_type, coalesce(channel, 'UNKNOWN') AS channel,
       CAST(NULL AS VARCHAR) AS counterparty_account, CAST(NULL AS VARCHAR) AS counterparty_name,
       CAST(NULL AS VARCHAR) AS counterparty_bank, CAST(NULL AS VARCHAR) AS counterparty_country,
       transaction_country_code, transaction_country_name, CAST(NULL AS VARCHAR) AS transaction_city,
       is_high_risk_country, transaction_timestamp, transaction_date, transaction_hour,
       CASE WHEN event_id % 5 <> 0 THEN transaction_date END AS value_date,
       is_international, is_high_value, is_unusual_time, business_day_flag, 'CORE' AS source_system,
       ingestion_timestamp, TIMESTAMP '2024-01-31' AS processing_timestamp
FROM sv)
SELECT *, CAST(round((33 - 5 - CAST(customer_segment IS NULL AS INTEGER) - CAST(customer_since_date IS NULL AS INTEGER)
       - CAST(exchange_rate IS NULL AS INTEGER) - CAST(value_date IS NULL AS INTEGER)) / CAST(33 AS DOUBLE), 2)
       AS DECIMAL(3,2)) AS data_quality_score
FROM full_rows"""


def quality_score_row(x: Inputs) -> DataFrame:
    columns = ["transaction_id", "amount", "currency", "channel", "transaction_country", "value_date"]
    scored = x.bronze.withColumn("data_quality_score", flags.null_share_score(columns))
    return scored.select("transaction_id", "data_quality_score")


QUALITY_ROW_SQL = f"""WITH {EVENTS_SQL}
SELECT transaction_id,
       CAST(round((6 - CAST(event_id % 107 = 0 AS INTEGER) - CAST(event_id % 113 = 0 AS INTEGER)
             - CAST(event_id % 5 = 0 AS INTEGER)) / CAST(6 AS DOUBLE), 2) AS DECIMAL(3,2)) AS data_quality_score
FROM ev"""


GENERATIONS = (
    T.StructType().add("transaction_id", "string").add("customer_id", "string").add("amount", "decimal(18,2)").add("currency", "string")
)


def message_generations(x: Inputs) -> DataFrame:
    """Messages of three generations in one table: with a new nested field, with amounts as text, and some broken."""
    path = run_dir(x.spark, "generations")
    raw = x.raw.withColumn("n", F.substring("transaction_id", 4, 10).cast("bigint"))
    text = F.when(F.col("n") % 31 == 2, "n/a").otherwise(F.col("amount").cast("string"))
    device = F.struct(F.concat(F.lit("m"), F.col("n") % 9).alias("model"))
    base = ["transaction_id", "customer_id", "currency"]
    generations = [
        F.struct(*base, "amount"),
        F.struct(*base, "amount", device.alias("device")),
        F.struct(*base, text.alias("amount"), F.lit(None).cast("string").alias("note")),
    ]
    for i, fields in enumerate(generations):
        value = F.when(F.col("n") % 37 == 5, F.concat(F.lit("{broken "), "transaction_id")).otherwise(F.to_json(fields))
        messages = raw.filter(F.col("n") % 3 == i).select(value.alias("value"))
        tables.append_table(ops.parse_evolving(messages, GENERATIONS), path)
    stored = tables.read_table(x.spark, path)
    return stored.select(
        *GENERATIONS.names,
        F.try_variant_get("other_fields", "$.device.model", "string").alias("device_model"),
        F.to_json("other_fields").alias("other_fields"),
        "unparsed",
    )


GENERATIONS_SQL = f"""WITH {RAW_SQL},
kinds AS (SELECT *, event_id % 37 = 5 AS broken, event_id % 3 = 1 AS has_device, event_id % 3 = 2 AND event_id % 31 = 2 AS no_amount FROM raw)
SELECT CASE WHEN NOT broken THEN transaction_id END AS transaction_id, CASE WHEN NOT broken THEN customer_id END AS customer_id,
       CASE WHEN NOT broken AND NOT no_amount THEN amount END AS amount, CASE WHEN NOT broken THEN currency END AS currency,
       CASE WHEN NOT broken AND has_device THEN 'm' || CAST(event_id % 9 AS VARCHAR) END AS device_model,
       CASE WHEN broken THEN NULL WHEN has_device THEN '{{"device":{{"model":"m' || CAST(event_id % 9 AS VARCHAR) || '"}}}}'
            WHEN no_amount THEN '{{"amount":"n/a"}}' END AS other_fields,
       CASE WHEN broken THEN '{{broken ' || transaction_id END AS unparsed
FROM kinds"""


ENTRIES = {
    "message_generations": Entry(message_generations, GENERATIONS_SQL),
    "parse_messages": Entry(parse_messages, PARSE_SQL),
    "contract_violations": Entry(contract_violations, VIOLATIONS_SQL),
    "generator_bronze": Entry(generator_bronze, GENERATOR_SQL),
    "cast_and_reject": Entry(cast_and_reject, CAST_SQL),
    "zero_bad_amounts": Entry(zero_bad_amounts, ZERO_SQL),
    "recent_transactions": Entry(recent_transactions, RECENT_SQL),
    "latest_copies": Entry(latest_copies, LATEST_SQL),
    "fx_convert": Entry(fx_convert, FX_SQL),
    "fx_dated": Entry(fx_dated, FX_DATED_SQL),
    "fx_as_of": Entry(fx_as_of, FX_AS_OF_SQL),
    "customer_enrich": Entry(customer_enrich, CUSTOMER_SQL),
    "customer_enrich_strict": Entry(customer_enrich_strict, STRICT_SQL),
    "unknown_customer_rows": Entry(unknown_customer_rows, UNKNOWN_SQL),
    "country_risk": Entry(country_risk, COUNTRY_SQL),
    "date_flags": Entry(date_flags, FLAGS_SQL),
    "silver_full": Entry(silver_full, SILVER_FULL_SQL),
    "quality_score_row": Entry(quality_score_row, QUALITY_ROW_SQL),
}
