"""The provided tables seen as payment transactions and customers.

The tables are clean, so defects (unparsable or negative amounts, broken times,
missing channels and countries, unknown customers and currencies) are derived
from the row ids, identically here and in the SQL twins below. Events of every
fiftieth user get an id that no customer has; the customer tables are read whole.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.money import mean
from ...operators import warehouse
from ..alerting import Dimensions

COUNTRY_CODES = ("AE", "RU", "CN", "TR", "IR", "DE", "FR", "KP", "GB", "US")
CURRENCIES = ("EUR", "USD", "GBP", "CHF", "JPY", "AED")
CHANNELS = ("ATM", "ONLINE", "BRANCH", "WIRE")
TYPES = {
    "purchase": "WIRE_TRANSFER",
    "view": "POS_PURCHASE",
    "click": "ONLINE_TRANSFER",
    "signup": "CASH_DEPOSIT",
    "error": "ATM_WITHDRAWAL",
}
KYC = ("APPROVED", "PENDING", "REJECTED")
USER = "CASE WHEN user_id % 50 = 49 THEN user_id + 50000000 ELSE user_id END AS user_id"


def pick(values: tuple[str, ...], index: str) -> str:
    """SQL for the value at ``index``, counted round and round."""
    items = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({items}), CAST(({index}) % {len(values)} AS INT) + 1)"


def padded(prefix: str, number: str, width: int) -> str:
    return f"concat('{prefix}', lpad(CAST({number} AS STRING), {width}, '0'))"


_TYPE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPES.items()) + " END"


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        """Events with a zoned timestamp and a money amount."""
        return self.table("events").selectExpr(
            "event_id",
            "CAST(ts AS TIMESTAMP) AS ts",
            USER,
            "event_type",
            "CAST(CAST(value AS DECIMAL(18,2)) * 100 AS DECIMAL(18,2)) AS amount",
        )

    @cached_property
    def bronze(self) -> DataFrame:
        """Untyped transactions as they come out of the message parser."""
        return self.events.selectExpr(
            f"{padded('TXN', 'event_id', 10)} AS transaction_id",
            f"{padded('REF', 'event_id', 8)} AS transaction_ref",
            f"{padded('C', 'user_id', 8)} AS customer_id",
            f"{padded('A', 'user_id * 3 + event_id % 3', 9)} AS account_id",
            """CASE WHEN event_id % 97 = 0 THEN 'n/a'
                    WHEN event_id % 89 = 0 THEN concat('-', CAST(amount AS STRING))
                    ELSE CAST(amount AS STRING) END AS amount""",
            f"{pick(CURRENCIES, 'event_id')} AS currency",
            "CASE WHEN event_id % 2 = 0 THEN 'DEBIT' ELSE 'CREDIT' END AS transaction_type",
            f"CASE WHEN event_id % 107 <> 0 THEN {pick(CHANNELS, 'event_id')} END AS channel",
            f"CASE WHEN event_id % 113 <> 0 THEN {pick(COUNTRY_CODES, 'event_id * 7')} END AS transaction_country",
            """CASE WHEN event_id % 101 = 0 THEN 'not a time'
                    ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') END AS transaction_timestamp""",
            "CASE WHEN event_id % 5 <> 0 THEN date_format(ts, 'yyyy-MM-dd') END AS value_date",
            "'CORE' AS source_system",
            "ts + make_interval(0, 0, 0, 0, 0, 0, event_id % 5) AS ingestion_timestamp",
        )

    @cached_property
    def messages(self) -> DataFrame:
        """The bronze rows as JSON messages with broker metadata; some are cut off."""
        fields = [c for c in self.bronze.columns if c != "ingestion_timestamp"]
        number = "CAST(substring(transaction_id, 4, 10) AS BIGINT)"
        return self.bronze.withColumn("text", F.to_json(F.struct(*fields))).selectExpr(
            "customer_id AS key",
            f"CASE WHEN {number} % 103 = 0 THEN substring(text, 1, 40) ELSE text END AS value",
            f"CAST({number} % 12 AS INT) AS partition",
            f"{number} AS offset",
            "ingestion_timestamp AS timestamp",
        )

    @cached_property
    def raw(self) -> DataFrame:
        """Source/destination transactions."""
        return self.events.selectExpr(
            f"{padded('TXN', 'event_id', 10)} AS transaction_id",
            f"{padded('C', 'user_id', 8)} AS customer_id",
            f"{_TYPE} AS transaction_type",
            "amount",
            f"{pick(CURRENCIES, 'event_id')} AS currency",
            f"{pick(COUNTRY_CODES, 'user_id')} AS source_country",
            f"{pick(COUNTRY_CODES, 'event_id * 7')} AS destination_country",
            "concat('MCC', CAST(event_id % 20 AS STRING)) AS merchant_category",
            f"{pick(CHANNELS, 'event_id')} AS channel",
            "concat('DEV', CAST(user_id % 1000 AS STRING)) AS device_id",
            "ts AS transaction_timestamp",
            "to_date(ts) AS transaction_date",
            "ts + make_interval(0, 0, 0, 0, 0, 0, event_id % 5) AS processing_timestamp",
            "to_date(ts) AS processing_date",
        )

    @cached_property
    def customers(self) -> DataFrame:
        """Customer dimension of rule pack A."""
        return self.table("customer").selectExpr(
            f"{padded('C', 'c_custkey', 8)} AS customer_id",
            "c_name AS customer_name",
            """CASE WHEN c_acctbal < 1500 THEN 'HIGH' WHEN c_acctbal < 4000 THEN 'MEDIUM'
                    ELSE 'LOW' END AS customer_risk_category""",
            "c_mktsegment AS customer_segment",
            "date_add(DATE '2010-01-01', CAST(c_custkey % 3000 AS INT)) AS customer_since_date",
            "c_custkey % 20 = 0 AS is_pep",
            f"{pick(COUNTRY_CODES, 'c_nationkey')} AS customer_country_code",
        )

    @cached_property
    def master(self) -> DataFrame:
        """Customer master of the source/destination model."""
        return self.table("customer").selectExpr(
            f"{padded('C', 'c_custkey', 8)} AS customer_id",
            "c_name AS customer_name",
            "date_add(DATE '2010-01-01', CAST(c_custkey % 3000 AS INT)) AS account_open_date",
            "c_mktsegment AS customer_segment",
            f"{pick(COUNTRY_CODES, 'c_nationkey')} AS country_of_residence",
            "c_custkey % 20 = 0 AS is_pep",
            f"{pick(KYC, 'c_custkey')} AS kyc_status",
            "CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 12 AS DOUBLE) * 0.05D END AS risk_score",
        )

    @cached_property
    def scoring_customers(self) -> DataFrame:
        """Master data with each customer's average amount."""
        averages = self.raw.groupBy("customer_id").agg(
            mean(F.col("amount")).alias("avg_transaction_amount")
        )
        return self.master.join(averages, "customer_id", "left")

    @cached_property
    def order_transactions(self) -> DataFrame:
        """Orders as day-grain transactions over several years."""
        return self.table("orders").selectExpr(
            f"{padded('ORD', 'o_orderkey', 10)} AS transaction_id",
            f"{padded('C', 'o_custkey', 8)} AS customer_id",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS amount",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS amount_eur",
            "CAST(o_orderdate AS TIMESTAMP) AS transaction_timestamp",
            "CAST(o_orderdate AS DATE) AS transaction_date",
            "o_orderstatus AS status",
            "o_orderkey AS order_number",
        )

    @cached_property
    def dimensions(self) -> Dimensions:
        return Dimensions(
            customers=self.customers,
            rates=warehouse.exchange_rates(self.spark),
            risk_countries=warehouse.listed_countries(self.spark),
            countries=warehouse.countries(self.spark),
        )


# --- the same frames in SQL -----------------------------------------------------------


def sql_list(values: tuple[str, ...], index: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{items}], CAST(({index}) % {len(values)} AS INTEGER) + 1)"


EVENTS_SQL = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(CAST(value AS DECIMAL(18,2)) * 100 AS DECIMAL(18,2)) AS amount,
         'TXN' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS transaction_id,
         'C' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS customer_id
  FROM (SELECT event_id, ts, event_type, value, {USER} FROM events))"""

# Accepted, typed bronze rows.
TYPED_SQL = f"""{EVENTS_SQL},
tx AS (
  SELECT event_id, transaction_id, customer_id,
         'A' || lpad(CAST(user_id * 3 + event_id % 3 AS VARCHAR), 9, '0') AS account_id,
         amount, {sql_list(CURRENCIES, "event_id")} AS currency,
         CASE WHEN event_id % 2 = 0 THEN 'DEBIT' ELSE 'CREDIT' END AS transaction_type,
         CASE WHEN event_id % 107 <> 0 THEN {sql_list(CHANNELS, "event_id")} END AS channel,
         CASE WHEN event_id % 113 <> 0 THEN {sql_list(COUNTRY_CODES, "event_id * 7")} END AS transaction_country,
         ts AS transaction_timestamp, CAST(ts AS DATE) AS transaction_date,
         ts + to_seconds(event_id % 5) AS ingestion_timestamp
  FROM ev
  WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 101 <> 0 AND amount > 0)"""

RATES_SQL = """
rates(currency, rate) AS (VALUES
  ('USD', CAST(0.92 AS DECIMAL(10,6))), ('GBP', CAST(1.17 AS DECIMAL(10,6))),
  ('CHF', CAST(1.08 AS DECIMAL(10,6))), ('JPY', CAST(0.0062 AS DECIMAL(10,6))),
  ('EUR', CAST(1.0 AS DECIMAL(10,6))))"""

COUNTRIES_SQL = """
countries(country_code, country_name, region, risk_score) AS (VALUES
  """ + ",\n  ".join(
    f"('{c}', '{n}', '{r}', CAST({s} AS DECIMAL(3,2)))" for c, n, r, s in warehouse.COUNTRIES
) + ")"

CUSTOMERS_SQL = f"""
customers AS (
  SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS customer_id, c_name AS customer_name,
         CASE WHEN c_acctbal < 1500 THEN 'HIGH' WHEN c_acctbal < 4000 THEN 'MEDIUM' ELSE 'LOW' END AS customer_risk_category,
         c_mktsegment AS customer_segment,
         CAST(DATE '2010-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS DATE) AS customer_since_date,
         c_custkey % 20 = 0 AS is_pep,
         {sql_list(COUNTRY_CODES, "c_nationkey")} AS customer_country_code
  FROM customer)"""

# Silver: enriched transactions with flags.
SILVER_SQL = f"""{TYPED_SQL},{RATES_SQL},{COUNTRIES_SQL},{CUSTOMERS_SQL},
sv AS (
  SELECT t.*, r.rate AS exchange_rate, r.rate IS NULL AS fx_missing,
         CAST(round(coalesce(t.amount * r.rate, t.amount), 2) AS DECIMAL(18,2)) AS amount_eur,
         coalesce(c.customer_name, 'UNKNOWN') AS customer_name,
         coalesce(c.customer_risk_category, 'UNKNOWN') AS customer_risk_category,
         c.customer_segment, c.customer_since_date,
         coalesce(c.is_pep, FALSE) AS is_pep, c.customer_country_code,
         coalesce(t.transaction_country, 'UNKNOWN') AS transaction_country_code,
         coalesce(k.country_name, 'UNKNOWN') AS transaction_country_name,
         coalesce(t.transaction_country IN ('AF','IR','KP','SY','YE'), FALSE) AS is_high_risk_country,
         CAST(hour(t.transaction_timestamp) AS INTEGER) AS transaction_hour,
         CAST(round(coalesce(t.amount * r.rate, t.amount), 2) AS DECIMAL(18,2)) >= 10000 AS is_high_value,
         hour(t.transaction_timestamp) >= 22 OR hour(t.transaction_timestamp) < 6 AS is_unusual_time,
         isodow(t.transaction_timestamp) <= 5 AS business_day_flag,
         coalesce(t.transaction_country <> c.customer_country_code, FALSE) AS is_international
  FROM tx t
  LEFT JOIN rates r USING (currency)
  LEFT JOIN customers c USING (customer_id)
  LEFT JOIN countries k ON k.country_code = t.transaction_country)"""

# Silver with the trailing 24-hour frame.
VELOCITY_SQL = f"""{SILVER_SQL},
vel AS (
  SELECT *, CAST(sum(amount_eur) OVER w AS DECIMAL(38,2)) AS rolling_24h_amount,
         count(*) OVER w AS rolling_24h_count,
         CAST(count(*) FILTER (WHERE amount_eur >= 9000 AND amount_eur < 10000) OVER w AS BIGINT) AS structuring_24h_count
  FROM sv
  WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_timestamp
               RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW))"""

RAW_SQL = f"""{EVENTS_SQL},
raw AS (
  SELECT event_id, transaction_id, customer_id, {_TYPE} AS transaction_type, amount,
         {sql_list(CURRENCIES, "event_id")} AS currency,
         {sql_list(COUNTRY_CODES, "user_id")} AS source_country,
         {sql_list(COUNTRY_CODES, "event_id * 7")} AS destination_country,
         'MCC' || CAST(event_id % 20 AS VARCHAR) AS merchant_category,
         {sql_list(CHANNELS, "event_id")} AS channel,
         'DEV' || CAST(user_id % 1000 AS VARCHAR) AS device_id,
         ts AS transaction_timestamp, CAST(ts AS DATE) AS transaction_date,
         ts + to_seconds(event_id % 5) AS processing_timestamp, CAST(ts AS DATE) AS processing_date
  FROM ev)"""

MASTER_SQL = f"""
master AS (
  SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS customer_id, c_name AS customer_name,
         CAST(DATE '2010-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS DATE) AS account_open_date,
         c_mktsegment AS customer_segment,
         {sql_list(COUNTRY_CODES, "c_nationkey")} AS country_of_residence,
         c_custkey % 20 = 0 AS is_pep, {sql_list(KYC, "c_custkey")} AS kyc_status,
         CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 12 AS DOUBLE) * CAST(0.05 AS DOUBLE) END AS risk_score
  FROM customer)"""

# Source/destination transactions with the six rules, score and priority.
ENRICHED_SQL = f"""{RAW_SQL},{MASTER_SQL},
averages AS (
  SELECT customer_id, CAST(sum(amount) AS DOUBLE) / CAST(count(amount) AS DOUBLE) AS avg_transaction_amount
  FROM raw SEMI JOIN master USING (customer_id) GROUP BY customer_id),
featured AS (
  SELECT r.*, a.avg_transaction_amount, m.is_pep, m.risk_score,
         CASE WHEN a.avg_transaction_amount > 0
              THEN CAST(r.amount AS DOUBLE) / a.avg_transaction_amount ELSE CAST(0 AS DOUBLE) END AS amount_vs_avg_ratio,
         r.destination_country IN ('AE','RU','CN','TR') AS is_high_risk_country,
         r.amount > 10000 AS is_large_amount,
         hour(r.transaction_timestamp) < 6 OR hour(r.transaction_timestamp) > 22 AS is_unusual_time,
         count(*) OVER (PARTITION BY r.customer_id ORDER BY r.transaction_timestamp
                        RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS rolling_24h_count
  FROM raw r LEFT JOIN master m USING (customer_id) LEFT JOIN averages a USING (customer_id)),
ruled AS (
  SELECT *,
         transaction_type IN ('CASH_DEPOSIT','ATM_WITHDRAWAL') AND amount > 10000 AS rule_1_triggered,
         destination_country IN ('AE','RU','CN','TR') AND amount > 5000 AS rule_2_triggered,
         amount_vs_avg_ratio > 5 AS rule_3_triggered,
         coalesce(is_pep AND transaction_type = 'WIRE_TRANSFER' AND amount > @PEP@, FALSE) AS rule_4_triggered,
         rolling_24h_count > @FREQ@ AS rule_5_triggered,
         is_high_risk_country AND is_unusual_time AS rule_6_triggered
  FROM featured),
counted AS (
  SELECT *, CAST(rule_1_triggered AS INTEGER) + CAST(rule_2_triggered AS INTEGER)
          + CAST(rule_3_triggered AS INTEGER) + CAST(rule_4_triggered AS INTEGER)
          + CAST(rule_5_triggered AS INTEGER) + CAST(rule_6_triggered AS INTEGER) AS total_rules_triggered
  FROM ruled),
scored AS (
  SELECT *, least(CAST(1 AS DOUBLE),
                  round(CAST(total_rules_triggered AS DOUBLE) * CAST(0.2 AS DOUBLE)
                        + coalesce(risk_score, CAST(0.3 AS DOUBLE)), 4)) AS transaction_risk_score
  FROM counted),
enriched AS (
  SELECT *, transaction_risk_score > 0.7 AS is_suspicious,
         CASE WHEN transaction_risk_score >= 0.9 THEN 'CRITICAL' WHEN transaction_risk_score >= 0.7 THEN 'HIGH'
              WHEN transaction_risk_score >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS alert_priority
  FROM scored)"""

# Orders as day-grain transactions.
ORDERS_SQL = """
ord AS (
  SELECT 'ORD' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS transaction_id,
         'C' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS customer_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_totalprice AS DECIMAL(18,2)) AS amount_eur,
         o_orderdate AS transaction_timestamp, CAST(o_orderdate AS DATE) AS transaction_date,
         o_orderstatus AS status, o_orderkey AS order_number
  FROM orders)"""
