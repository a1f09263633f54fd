"""Customer behaviour profiles and risk categories."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ProfileConfig
from ..functions import risk
from ..functions.flags import account_age_days, is_true
from ..functions.money import count_when, exact_avg, money_avg
from ..schemas import GOLD_CUSTOMER_DAILY_SUMMARY
from .velocity import gap_statistics


def in_lookback(df: DataFrame, as_of: date, days: int, column: str = "transaction_date") -> DataFrame:
    """Rows dated ``as_of - days`` to ``as_of``, both included.

    A range on the (partition) column itself, so partitions are pruned.
    """
    return df.filter(F.col(column).between(F.lit(as_of - timedelta(days=days)), F.lit(as_of)))


def customer_profiles(silver: DataFrame, as_of: date, cfg: ProfileConfig) -> DataFrame:
    """90-day and 30-day behaviour in one pass over the transactions.

    A customer without 30-day activity has NULL, not 0, 30-day measures.
    """
    recent = F.col("transaction_date") >= F.lit(as_of - timedelta(days=cfg.recent_days))
    amount = F.col("amount_eur")

    def share(column: str) -> Column:
        return F.try_divide(F.col(column).cast("double"), F.col("transaction_count_90d").cast("double"))

    grouped = (
        in_lookback(silver, as_of, cfg.lookback_days)
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("transaction_count_90d"),
            count_when(F.col("transaction_type") == "DEBIT").alias("debit_count_90d"),
            count_when(F.col("transaction_type") == "CREDIT").alias("credit_count_90d"),
            F.sum(amount).cast("decimal(38,2)").alias("total_amount_90d"),
            F.max(amount).alias("max_transaction_amount_90d"),
            F.min(amount).alias("min_transaction_amount_90d"),
            count_when(F.col("channel") == "ATM").alias("atm_count_90d"),
            count_when(F.col("channel") == "ONLINE").alias("online_count_90d"),
            count_when(F.col("channel") == "BRANCH").alias("branch_count_90d"),
            count_when(F.col("is_high_value")).alias("high_value_count_90d"),
            count_when(F.col("is_international")).alias("international_count_90d"),
            count_when(F.col("is_high_risk_country")).alias("high_risk_country_count_90d"),
            count_when(F.col("is_unusual_time")).alias("unusual_time_count_90d"),
            F.max("transaction_date").alias("last_transaction_date"),
            F.nullif(count_when(recent), F.lit(0)).alias("transaction_count_30d"),
            F.sum(F.when(recent, amount)).alias("__recent_amount"),
            F.count(amount).alias("__amounts"),
            F.count(F.when(recent, amount)).alias("__recent_amounts"),
        )
    )
    return (
        grouped.withColumns(
            {
                "avg_transaction_amount_90d": exact_avg(F.col("total_amount_90d"), F.col("__amounts")),
                "avg_transaction_amount_30d": exact_avg(
                    F.col("__recent_amount"), F.col("__recent_amounts")
                ),
                "avg_daily_amount_90d": F.col("total_amount_90d").cast("double") / cfg.lookback_days,
                "high_value_ratio": share("high_value_count_90d"),
                "international_ratio": share("international_count_90d"),
            }
        )
        .drop("__recent_amount", "__amounts", "__recent_amounts")
        .withColumn("risk_category", risk.profile_category(cfg))
    )


def stamp_profiles(profiles: DataFrame, as_of: date, computed_at: Column) -> DataFrame:
    return profiles.withColumns({"effective_date": F.lit(as_of), "computed_at": computed_at})


def category_summary(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("risk_category").agg(
        F.count("*").alias("customer_count"),
        F.avg("avg_transaction_amount_90d").alias("avg_amount"),
        F.avg("transaction_count_90d").alias("avg_tx_count"),
    )


def extended_profiles(
    enriched: DataFrame, customers: DataFrame, as_of: date, cfg: ProfileConfig
) -> DataFrame:
    """The wide profile: amounts, mix of types and channels, time habits, gaps, risk.

    Totals and habits are over all transactions up to ``as_of``; the last 90 and 30
    days are counted in the same pass.
    The transactions are reduced to one row per customer before the customer
    attributes are joined, so the join never sees a hot key.
    """
    window = enriched.filter(F.col("transaction_date") <= F.lit(as_of))
    lately = F.col("transaction_date") >= F.lit(as_of - timedelta(days=cfg.lookback_days))
    recent = F.col("transaction_date") >= F.lit(as_of - timedelta(days=cfg.recent_days))
    amount = F.col("amount")
    hour = F.hour("transaction_timestamp")
    weekend = F.dayofweek("transaction_timestamp").isin(1, 7)

    def of_type(name: str) -> Column:
        return count_when(F.col("transaction_type") == name)

    def on_channel(name: str) -> Column:
        return count_when(F.col("channel") == name)

    behaviour = (
        window.groupBy("customer_id")
        .agg(
            F.count("*").alias("total_transactions"),
            F.sum(amount).cast("decimal(38,2)").alias("total_volume"),
            F.max(amount).alias("max_transaction_amount"),
            F.stddev_samp(amount.cast("double")).alias("stddev_transaction_amount"),
            count_when(lately).alias("total_transactions_90d"),
            F.coalesce(F.sum(F.when(lately, amount)), F.lit(0)).cast("decimal(38,2)").alias("total_volume_90d"),
            count_when(recent).alias("total_transactions_30d"),
            F.coalesce(F.sum(F.when(recent, amount)), F.lit(0)).cast("decimal(38,2)").alias("total_volume_30d"),
            of_type("WIRE_TRANSFER").alias("wire_transfer_count"),
            of_type("CASH_DEPOSIT").alias("cash_deposit_count"),
            of_type("ONLINE_TRANSFER").alias("online_transfer_count"),
            count_when(F.col("is_high_risk_country")).alias("high_risk_country_count"),
            count_when(F.col("is_large_amount")).alias("large_amount_count"),
            count_when(F.col("is_unusual_time")).alias("unusual_time_count"),
            count_when(F.col("is_suspicious")).alias("suspicious_transaction_count"),
            # Country codes form a small closed set, so a set per customer is bounded.
            F.size(F.collect_set("source_country")).alias("unique_source_countries"),
            F.size(F.collect_set("destination_country")).alias("unique_destination_countries"),
            on_channel("ONLINE").alias("online_channel_count"),
            on_channel("BRANCH").alias("branch_channel_count"),
            on_channel("ATM").alias("atm_channel_count"),
            count_when(weekend).alias("weekend_transactions"),
            count_when(~weekend).alias("weekday_transactions"),
            count_when(hour.between(6, 11)).alias("morning_transactions"),
            count_when(hour.between(12, 17)).alias("afternoon_transactions"),
            count_when(hour.between(18, 21)).alias("evening_transactions"),
            count_when((hour >= 22) | (hour < 6)).alias("night_transactions"),
            F.max("transaction_timestamp").alias("last_transaction_date"),
        )
        .withColumns(
            {
                "avg_transaction_amount": exact_avg(F.col("total_volume"), F.col("total_transactions")),
                "avg_amount_30d": exact_avg(F.col("total_volume_30d"), F.col("total_transactions_30d")),
            }
        )
    )
    attributes = customers.select(
        "customer_id",
        "customer_name",
        "customer_segment",
        "account_open_date",
        account_age_days(F.lit(as_of), F.col("account_open_date")).alias("account_age_days"),
        "country_of_residence",
        is_true(F.col("is_pep")).alias("is_pep"),
        "kyc_status",
    )
    joined = behaviour.join(gap_statistics(window), "customer_id", "left").join(
        attributes, "customer_id", "left"
    )
    return weigh_risk(joined, cfg)


def weigh_risk(profiles: DataFrame, cfg: ProfileConfig) -> DataFrame:
    """Seven capped ratios and their weighted sum, all in 0..1.

    The model names the parts without a formula; this one is ours.
    """
    n = F.col("total_transactions").cast("double")

    def capped(value: Column) -> Column:
        return F.round(F.least(F.lit(1.0), F.coalesce(value, F.lit(0.0))), 4)

    parts = {
        "volume_risk": capped(F.col("total_volume").cast("double") / cfg.volume_full_risk),
        "frequency_risk": capped(n / cfg.frequency_full_risk),
        "high_risk_country_risk": capped(F.try_divide(F.col("high_risk_country_count").cast("double"), n)),
        "suspicious_activity_risk": capped(
            F.try_divide(F.col("suspicious_transaction_count").cast("double"), n)
        ),
        "unusual_behavior_risk": capped(F.try_divide(F.col("unusual_time_count").cast("double"), n)),
        "pep_risk": F.when(F.col("is_pep"), F.lit(1.0)).otherwise(F.lit(0.0)),
        "cash_risk": capped(F.try_divide(F.col("cash_deposit_count").cast("double"), n)),
    }
    score = F.lit(0.0)
    for name in parts:
        score = score + F.col(name) * cfg.weights[name]
    scored = profiles.withColumns(parts).withColumn("risk_score", F.round(score, 4))
    return scored.withColumn(
        "risk_category",
        F.when(F.col("risk_score") >= 0.5, "HIGH").when(F.col("risk_score") >= 0.3, "MEDIUM").otherwise("LOW"),
    )


def daily_summary(silver: DataFrame, alerts: DataFrame, computed_at: Column) -> DataFrame:
    """Per customer and day: activity plus the alerts raised that day.

    Both sides are aggregated to (customer, day) before they are joined.
    ``alerts`` carries ``transaction_date`` and ``alert_severity``.
    """
    amount = F.col("amount_eur")
    activity = silver.groupBy("customer_id", F.col("transaction_date").alias("summary_date")).agg(
        F.count("*").alias("transaction_count"),
        F.sum(amount).alias("total_amount_eur"),
        F.max(amount).alias("max_transaction_amount"),
        F.min(amount).alias("min_transaction_amount"),
        count_when(F.col("transaction_type") == "DEBIT").alias("debit_count"),
        count_when(F.col("transaction_type") == "CREDIT").alias("credit_count"),
        count_when(F.col("is_international")).alias("international_count"),
        count_when(F.col("is_high_risk_country")).alias("high_risk_country_count"),
        count_when(F.col("channel") == "ATM").alias("atm_count"),
        count_when(F.col("channel") == "ONLINE").alias("online_count"),
        count_when(F.col("channel") == "BRANCH").alias("branch_count"),
    )
    raised = alerts.groupBy("customer_id", F.col("transaction_date").alias("summary_date")).agg(
        F.count("*").alias("alert_count"),
        count_when(F.col("alert_severity").isin("HIGH", "CRITICAL")).alias("high_severity_alert_count"),
    )
    joined = activity.join(raised, ["customer_id", "summary_date"], "left").withColumns(
        {
            "avg_transaction_amount": money_avg(F.col("total_amount_eur"), F.col("transaction_count")),
            "alert_count": F.coalesce("alert_count", F.lit(0)),
            "high_severity_alert_count": F.coalesce("high_severity_alert_count", F.lit(0)),
            "computed_at": computed_at,
        }
    )
    return joined.select(*[F.col(f.name).cast(f.dataType) for f in GOLD_CUSTOMER_DAILY_SUMMARY.fields])
