"""Star schema: dimensions, facts, aggregates and views.

Facts are aggregated on their key columns before dimensions are joined, so the
joins handle a few grouped rows rather than the facts themselves.
"""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.flags import is_true
from ..functions.keys import date_key, surrogate_key
from ..functions.money import count_when, exact_avg
from ..functions.risk import RULE_CATALOGUE, priority_rank
from .asof import last_version
from .grouping import keep_latest
from .reports import rule_effectiveness

UNKNOWN_KEY = -1

# Transaction types with category and base risk.
TRANSACTION_TYPES = (
    ("ATM_WITHDRAWAL", "ATM Withdrawal", "CASH", Decimal("0.10")),
    ("POS_PURCHASE", "POS Purchase", "CARD", Decimal("0.05")),
    ("ONLINE_TRANSFER", "Online Transfer", "TRANSFER", Decimal("0.30")),
    ("WIRE_TRANSFER", "Wire Transfer", "TRANSFER", Decimal("0.50")),
    ("CHECK_DEPOSIT", "Check Deposit", "DEPOSIT", Decimal("0.20")),
    ("CASH_DEPOSIT", "Cash Deposit", "CASH", Decimal("0.40")),
)

# Alert life-cycle states, whether they count as open, sort order.
ALERT_STATUSES = (
    ("NEW", "New", True, 1),
    ("OPEN", "Open", True, 2),
    ("UNDER_REVIEW", "Under review", True, 3),
    ("ESCALATED", "Escalated", True, 4),
    ("REVIEWED", "Reviewed", False, 5),
    ("CLOSED", "Closed", False, 6),
    ("FALSE_POSITIVE", "False positive", False, 7),
)

# Countries that occur in the data model, with region and risk.
COUNTRIES = (
    ("AE", "United Arab Emirates", "Middle East", Decimal("0.60")),
    ("AF", "Afghanistan", "Asia", Decimal("0.90")),
    ("CH", "Switzerland", "Europe", Decimal("0.20")),
    ("CN", "China", "Asia", Decimal("0.50")),
    ("DE", "Germany", "Europe", Decimal("0.10")),
    ("FR", "France", "Europe", Decimal("0.10")),
    ("GB", "United Kingdom", "Europe", Decimal("0.10")),
    ("IR", "Iran", "Middle East", Decimal("0.90")),
    ("KP", "North Korea", "Asia", Decimal("0.90")),
    ("NL", "Netherlands", "Europe", Decimal("0.10")),
    ("RU", "Russia", "Europe", Decimal("0.80")),
    ("SY", "Syria", "Middle East", Decimal("0.90")),
    ("TR", "Turkey", "Middle East", Decimal("0.40")),
    ("US", "United States", "North America", Decimal("0.20")),
    ("YE", "Yemen", "Middle East", Decimal("0.90")),
)
HIGH_RISK_FROM = Decimal("0.50")
SANCTIONED_FROM = Decimal("0.90")

# Listed high-risk countries.
LISTED_COUNTRIES = ("AF", "IR", "KP", "SY", "YE")

# Reference exchange rates to EUR.
EXCHANGE_RATES = (
    ("USD", Decimal("0.920000")),
    ("GBP", Decimal("1.170000")),
    ("CHF", Decimal("1.080000")),
    ("JPY", Decimal("0.006200")),
    ("EUR", Decimal("1.000000")),
)


def _constant(spark: SparkSession, rows, names: list[str]) -> DataFrame:
    """A fixed table as a local relation, whose size the planner knows."""
    columns = list(zip(*rows, strict=True))
    return spark.createDataFrame(pa.table({n: pa.array(c) for n, c in zip(names, columns, strict=True)}))


# --- reference frames ---------------------------------------------------------------


def exchange_rates(spark: SparkSession) -> DataFrame:
    return _constant(spark, EXCHANGE_RATES, ["currency", "rate_to_eur"]).withColumn(
        "rate_to_eur", F.col("rate_to_eur").cast("decimal(10,6)")
    )


def countries(spark: SparkSession) -> DataFrame:
    return _constant(spark, COUNTRIES, ["country_code", "country_name", "region", "risk_score"])


def listed_countries(spark: SparkSession) -> DataFrame:
    listed = [(c[0], c[1], "HIGH", True) for c in COUNTRIES if c[0] in LISTED_COUNTRIES]
    return _constant(spark, listed, ["country_code", "country_name", "risk_level", "fatf_listed"])


# --- dimensions ---------------------------------------------------------------------


def dim_date(bounds: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """One row per calendar day between ``first_day`` and ``last_day`` of the one-row input."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    d = F.col("full_date")
    iso_day = F.weekday(d) + 1
    calendar = days.select(
        date_key(d).alias("date_sk"),
        d,
        iso_day.cast("int").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (iso_day >= 6).alias("is_weekend"),
        (iso_day <= 5).alias("is_business_day"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
    )
    if holidays is None:
        return calendar.withColumn("is_holiday", F.lit(False))
    marked = holidays.select(F.col("holiday_date").alias("full_date"), "holiday_name")
    return calendar.join(marked, "full_date", "left").withColumn(
        "is_holiday", F.col("holiday_name").isNotNull()
    )


def date_bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.to_date(F.min(column)).alias("first_day"), F.to_date(F.max(column)).alias("last_day")
    )


def dim_transaction_type(spark: SparkSession) -> DataFrame:
    rows = _constant(
        spark,
        TRANSACTION_TYPES,
        ["transaction_type_code", "transaction_type_name", "transaction_category", "base_risk_level"],
    )
    return rows.withColumns(
        {
            "transaction_type_sk": surrogate_key(F.col("transaction_type_code")),
            "base_risk_level": F.col("base_risk_level").cast("decimal(3,2)"),
            "is_active": F.lit(True),
        }
    )


def dim_alert_status(spark: SparkSession) -> DataFrame:
    return _constant(spark, ALERT_STATUSES, ["status_code", "status_name", "is_open", "sort_order"]).withColumn(
        "alert_status_sk", surrogate_key(F.col("status_code"))
    )


def dim_geography(codes: DataFrame, reference: DataFrame) -> DataFrame:
    """One row per distinct ``country_code`` in use; unlisted codes stay, unrated."""
    used = codes.select("country_code").filter("country_code IS NOT NULL").distinct()
    score = F.col("risk_score")
    return used.join(reference, "country_code", "left").select(
        surrogate_key(F.col("country_code")).alias("geography_sk"),
        "country_code",
        F.coalesce("country_name", F.lit("UNKNOWN")).alias("country_name"),
        F.coalesce("region", F.lit("UNKNOWN")).alias("region"),
        F.when(score >= HIGH_RISK_FROM, "HIGH")
        .when(score >= Decimal("0.30"), "MEDIUM")
        .when(score.isNotNull(), "LOW")
        .otherwise("UNKNOWN")
        .alias("risk_rating"),
        score.cast("decimal(3,2)").alias("risk_score"),
        is_true(score >= HIGH_RISK_FROM).alias("is_high_risk"),
        is_true(score >= SANCTIONED_FROM).alias("is_sanctioned"),
    )


def dim_rule(spark: SparkSession, alerts: DataFrame) -> DataFrame:
    """Rule catalogue with the effectiveness measured on ``alerts``."""
    rows = [
        (
            r.rule_id,
            r.rule_name,
            r.rule_category,
            None if r.threshold_value is None else Decimal(r.threshold_value),
            r.threshold_currency,
            r.time_window_hours,
        )
        for r in RULE_CATALOGUE
    ]
    catalogue = _constant(
        spark,
        rows,
        ["rule_id", "rule_name", "rule_category", "threshold_value", "threshold_currency", "time_window_hours"],
    )
    joined = catalogue.join(rule_effectiveness(alerts), "rule_id", "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        surrogate_key(F.col("rule_id")).alias("rule_key"),
        "rule_id",
        "rule_name",
        "rule_category",
        F.col("threshold_value").cast("decimal(18,2)").alias("threshold_value"),
        "threshold_currency",
        F.col("time_window_hours").cast("int").alias("time_window_hours"),
        F.coalesce("total_alerts_generated", zero).alias("total_alerts_generated"),
        F.coalesce("true_positive_count", zero).alias("true_positive_count"),
        F.coalesce("false_positive_count", zero).alias("false_positive_count"),
        F.col("precision_rate").cast("decimal(5,4)").alias("precision_rate"),
        F.lit(True).alias("is_active"),
    )


def dim_customer(history: DataFrame) -> DataFrame:
    """Surrogate key per customer version."""
    return history.withColumn(
        "customer_sk", surrogate_key(F.col("customer_id"), F.date_format("effective_date", "yyyy-MM-dd"))
    )


def dim_account(transactions: DataFrame) -> DataFrame:
    """Accounts seen in the transactions, opened on their first day."""
    return transactions.groupBy("account_id", "customer_id").agg(
        F.min("transaction_date").alias("account_open_date")
    ).select(
        surrogate_key(F.col("account_id"), F.col("customer_id")).alias("account_key"),
        "account_id",
        "customer_id",
        F.lit("ACTIVE").alias("account_status"),
        "account_open_date",
    )


# --- facts --------------------------------------------------------------------------


def _valid_at(dim: DataFrame, ts: Column) -> Column:
    """Version of the customer that was valid at ``ts``."""
    end = dim["end_date"]
    return (dim["effective_date"] <= ts) & (end.isNull() | (ts < end))


def _carried(enriched: DataFrame, versions: DataFrame) -> DataFrame:
    """``customer_sk`` of the last version, where that has not ended by then."""
    found = last_version(
        enriched, versions, "customer_id", "transaction_timestamp", "effective_date", ["customer_sk", "end_date"]
    )
    ended = F.col("end_date") <= F.col("transaction_timestamp")
    return found.withColumn("customer_sk", F.when(~F.coalesce(ended, F.lit(False)), F.col("customer_sk"))).drop("end_date")


def fact_transaction(
    enriched: DataFrame,
    customers: DataFrame,
    types: DataFrame,
    geography: DataFrame,
    carry_forward: bool = False,
) -> DataFrame:
    """Transactions with the keys of their dimensions; unmatched keys are -1.

    ``carry_forward`` finds customer versions by one ordered pass (``asof``) instead of a
    join: for customers with very many versions or rows.

    Type and geography keys are hashes of their codes, but the join is kept so
    that codes missing from a dimension are visible as -1.
    """
    versions = customers.select("customer_id", "customer_sk", "effective_date", "end_date")
    if carry_forward:
        df = _carried(enriched, versions)
    else:
        df = enriched.join(
            versions,
            (enriched["customer_id"] == versions["customer_id"])
            & _valid_at(versions, enriched["transaction_timestamp"]),
            "left",
        ).drop(versions["customer_id"], versions["effective_date"], versions["end_date"])
    type_keys = types.select(
        F.col("transaction_type_code").alias("transaction_type"), "transaction_type_sk"
    )
    source = geography.select(
        F.col("country_code").alias("source_country"), F.col("geography_sk").alias("source_geography_sk")
    )
    target = geography.select(
        F.col("country_code").alias("destination_country"), F.col("geography_sk").alias("dest_geography_sk")
    )
    joined = (
        df.join(type_keys, "transaction_type", "left")
        .join(source, "source_country", "left")
        .join(target, "destination_country", "left")
    )
    unknown = F.lit(UNKNOWN_KEY).cast("bigint")
    return joined.select(
        surrogate_key(F.col("transaction_id")).alias("transaction_sk"),
        "transaction_id",
        F.coalesce("customer_sk", unknown).alias("customer_sk"),
        F.coalesce("transaction_type_sk", unknown).alias("transaction_type_sk"),
        F.coalesce("source_geography_sk", unknown).alias("source_geography_sk"),
        F.coalesce("dest_geography_sk", unknown).alias("dest_geography_sk"),
        date_key(F.to_date("transaction_timestamp")).alias("transaction_date_sk"),
        "transaction_timestamp",
        "processing_timestamp",
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        "currency",
        "channel",
        "device_id",
        "merchant_category",
        F.col("transaction_risk_score").cast("decimal(5,4)").alias("transaction_risk_score"),
        "is_suspicious",
        "is_high_risk_country",
        "is_large_amount",
        "is_unusual_time",
        F.col("amount_vs_avg_ratio").cast("decimal(10,2)").alias("amount_vs_avg_ratio"),
        *[f"rule_{i}_triggered" for i in range(1, 7)],
        "total_rules_triggered",
    )


def fact_alert(alerts: DataFrame, customers: DataFrame, statuses: DataFrame) -> DataFrame:
    """Alerts with the keys of transaction, customer version, status and day."""
    versions = customers.select("customer_id", "customer_sk", "effective_date", "end_date")
    df = alerts.join(
        versions,
        (alerts["customer_id"] == versions["customer_id"])
        & _valid_at(versions, alerts["alert_generated_at"]),
        "left",
    ).drop(versions["customer_id"], versions["effective_date"], versions["end_date"])
    status_keys = statuses.select(F.col("status_code").alias("alert_status"), "alert_status_sk")
    unknown = F.lit(UNKNOWN_KEY).cast("bigint")
    identity = surrogate_key(F.col("transaction_id"), F.col("alert_generated_at"))
    return df.join(status_keys, "alert_status", "left").select(
        identity.alias("alert_sk"),
        F.sha2(F.concat_ws("|", "transaction_id", "alert_priority"), 256).alias("alert_id"),
        surrogate_key(F.col("transaction_id")).alias("transaction_sk"),
        F.coalesce("customer_sk", unknown).alias("customer_sk"),
        F.coalesce("alert_status_sk", unknown).alias("alert_status_sk"),
        date_key(F.to_date("alert_generated_at")).alias("alert_date_sk"),
        "alert_generated_at",
        "alert_priority",
        F.col("transaction_risk_score").cast("decimal(5,4)").alias("transaction_risk_score"),
        "total_rules_triggered",
        "reviewed_by",
        "reviewed_at",
        # Filled by the case system, not by this engine.
        F.lit(None).cast("string").alias("resolution_notes"),
        F.lit(None).cast("string").alias("case_id"),
        F.lit(None).cast("boolean").alias("is_str_filed"),
        F.lit(None).cast("timestamp").alias("str_filed_date"),
    )


def fact_customer_daily_metrics(facts: DataFrame, channels: tuple[str, ...] = ("ONLINE", "BRANCH", "ATM")) -> DataFrame:
    per_channel = [
        count_when(F.col("channel") == c).alias(f"{c.lower()}_transaction_count") for c in channels
    ]
    return (
        facts.groupBy("customer_sk", F.col("transaction_date_sk").alias("metric_date_sk"))
        .agg(
            F.count("*").alias("daily_transaction_count"),
            F.sum("amount").alias("__volume"),
            F.max("amount").alias("daily_max_transaction_amount"),
            count_when(F.col("is_suspicious")).alias("daily_suspicious_count"),
            count_when(F.col("is_high_risk_country")).alias("daily_high_risk_country_count"),
            count_when(F.col("is_large_amount")).alias("daily_large_amount_count"),
            count_when(F.col("is_unusual_time")).alias("daily_unusual_time_count"),
            *per_channel,
        )
        .withColumns(
            {
                "customer_daily_sk": surrogate_key(F.col("customer_sk"), F.col("metric_date_sk")),
                "daily_transaction_volume": F.col("__volume").cast("decimal(38,2)"),
                "daily_avg_transaction_amount": exact_avg(
                    F.col("__volume"), F.col("daily_transaction_count")
                ),
            }
        )
        .drop("__volume")
    )


def with_current_risk(metrics: DataFrame, customers: DataFrame) -> DataFrame:
    """Daily metrics with ``current_risk_score`` and ``current_risk_category`` of the customer's current version.

    Metrics carry the key of the version that was valid on their day, so the
    customer is found by that key first. Null for the unknown customer and for
    customers without a current version.
    """
    current = keep_latest(
        customers.filter("is_current").select(
            "customer_id", "effective_date", F.col("risk_score").alias("current_risk_score"), F.col("risk_category").alias("current_risk_category")
        ),
        ["customer_id"],
        [F.col("effective_date").desc(), F.col("current_risk_score").desc()],
    ).drop("effective_date")
    keys = customers.select("customer_sk", "customer_id").distinct().join(current, "customer_id").drop("customer_id")
    return metrics.join(keys, "customer_sk", "left")


def monthly_summary(facts: DataFrame) -> DataFrame:
    """Month x type x destination: counts, volumes, suspicious share, customers."""
    suspicious = F.col("is_suspicious")
    return (
        facts.groupBy(
            F.date_format("transaction_timestamp", "yyyy-MM").alias("year_month"),
            "transaction_type_sk",
            F.col("dest_geography_sk").alias("geography_sk"),
        )
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("amount").cast("decimal(38,2)").alias("total_volume"),
            count_when(suspicious).alias("suspicious_count"),
            F.coalesce(F.sum(F.when(suspicious, F.col("amount"))), F.lit(0))
            .cast("decimal(38,2)")
            .alias("suspicious_volume"),
            F.countDistinct("customer_sk").alias("unique_customers"),
        )
        .withColumns(
            {
                "avg_amount": exact_avg(F.col("total_volume"), F.col("transaction_count")),
                "summary_sk": surrogate_key(
                    F.col("year_month"), F.col("transaction_type_sk"), F.col("geography_sk")
                ),
            }
        )
    )


def customer_risk_history(
    facts: DataFrame, profiles: DataFrame, snapshot_date: date, days: int = 30
) -> DataFrame:
    """Risk and 30-day activity per customer version, as of the snapshot date.

    ``profiles`` has one row per ``customer_sk`` with risk_score, risk_category and
    is_current. Current versions without activity have a row of zeros.
    """
    first = snapshot_date - timedelta(days=days)
    day = F.col("transaction_date_sk")
    recent = facts.filter(day.between(_as_key(first), _as_key(snapshot_date)))
    activity = recent.groupBy("customer_sk").agg(
        F.count("*").alias("total_transactions_30d"),
        F.sum("amount").cast("decimal(38,2)").alias("total_volume_30d"),
        count_when(F.col("is_suspicious")).alias("suspicious_count_30d"),
        count_when(F.col("is_high_risk_country")).alias("high_risk_country_count_30d"),
    )
    known = profiles.select("customer_sk", "risk_score", "risk_category", "is_current")
    joined = activity.join(known, "customer_sk", "full_outer").where(F.col("total_transactions_30d").isNotNull() | F.col("is_current"))
    counts = [c for c in activity.columns if c != "customer_sk"]
    return (
        joined.select("customer_sk", *[F.coalesce(c, F.lit(0).cast(activity.schema[c].dataType)).alias(c) for c in counts], "risk_score", "risk_category")
        .withColumn("snapshot_date", F.lit(snapshot_date))
        .withColumn("risk_history_sk", surrogate_key(F.col("customer_sk"), F.col("snapshot_date")))
    )


def _as_key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


# --- views --------------------------------------------------------------------------


def high_risk_customers(customers: DataFrame) -> DataFrame:
    return (
        customers.filter(F.col("is_current") & (F.col("risk_category") == "HIGH"))
        .select(
            "customer_id",
            "customer_name",
            "risk_score",
            "risk_category",
            "customer_segment",
            "country_of_residence",
            "is_pep",
        )
        .orderBy(F.desc("risk_score"))
    )


def open_alerts(alerts: DataFrame, customers: DataFrame, statuses: DataFrame, as_of: Column) -> DataFrame:
    """Open alerts with their age and the customer as known today, most urgent first.

    An alert keeps the customer version it was raised for; the name comes from the
    current one. Alerts of unknown customers stay, without a name.
    """
    open_keys = statuses.filter("is_open").select("alert_status_sk")
    versions = customers.select("customer_sk", "customer_id")
    current = customers.filter("is_current").select("customer_id", "customer_name")
    return (
        alerts.join(open_keys, "alert_status_sk", "left_semi")
        .join(versions, "customer_sk", "left")
        .join(current, "customer_id", "left")
        .select(
            "alert_id",
            "customer_id",
            "customer_name",
            "alert_priority",
            "transaction_risk_score",
            "alert_generated_at",
            F.datediff(F.to_date(as_of), F.to_date("alert_generated_at")).alias("days_open"),
            "total_rules_triggered",
        )
        .orderBy(priority_rank(F.col("alert_priority")), "alert_generated_at")
    )


def volume_by_country(facts: DataFrame, dates: DataFrame, geography: DataFrame) -> DataFrame:
    """Daily volume per destination country and rating."""
    grouped = facts.groupBy("transaction_date_sk", "dest_geography_sk").agg(
        F.count("transaction_id").alias("__count"),
        F.sum("amount").alias("__volume"),
        count_when(F.col("is_suspicious")).alias("__suspicious"),
    )
    return (
        grouped.join(dates.select(F.col("date_sk").alias("transaction_date_sk"), "full_date"), "transaction_date_sk")
        .join(
            geography.select(F.col("geography_sk").alias("dest_geography_sk"), "country_name", "risk_rating"),
            "dest_geography_sk",
        )
        .groupBy("full_date", "country_name", "risk_rating")
        .agg(
            F.sum("__count").alias("transaction_count"),
            F.sum("__volume").cast("decimal(38,2)").alias("total_volume"),
            F.sum("__suspicious").alias("suspicious_count"),
        )
        .withColumn("avg_amount", exact_avg(F.col("total_volume"), F.col("transaction_count")))
    )


def top_risk_profiles(profiles: DataFrame, n: int = 100) -> DataFrame:
    return (
        profiles.filter("is_current")
        .select(
            "customer_id",
            "risk_category",
            "risk_score",
            "total_transactions_30d",
            "suspicious_transaction_count",
        )
        .orderBy(F.desc("risk_score"), "customer_id")
        .limit(n)
    )


def partition_counts(df: DataFrame, partition: str = "processing_date") -> DataFrame:
    """Rows and distinct customers per partition, newest first."""
    return (
        df.groupBy(partition)
        .agg(F.count("*").alias("record_count"), F.countDistinct("customer_id").alias("unique_customers"))
        .orderBy(F.desc(partition))
    )


def heaviest_keys(df: DataFrame, key: str, n: int = 100) -> DataFrame:
    """Skew check: the keys with the most rows."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), key)
        .limit(n)
    )
