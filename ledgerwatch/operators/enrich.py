"""Dimension look-ups and derived features.

None of the joins carries a broadcast hint: Spark broadcasts a dimension when
its measured size is under the session threshold and otherwise shuffles, where
adaptive execution splits the hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import RuleConfigA
from ..functions import flags
from ..functions.money import to_eur

UNKNOWN = "UNKNOWN"


def attach_customer(df: DataFrame, customers: DataFrame, strict: bool = False) -> DataFrame:
    """Customer attributes by ``customer_id``.

    Unknown customers keep their rows with UNKNOWN name and category, or are
    dropped when ``strict``.
    """
    joined = df.join(customers, "customer_id", "inner" if strict else "left")
    return joined.withColumns(
        {
            "customer_name": F.coalesce("customer_name", F.lit(UNKNOWN)),
            "customer_risk_category": F.coalesce("customer_risk_category", F.lit(UNKNOWN)),
            "is_pep": flags.is_true(F.col("is_pep")),
        }
    )


def unknown_customers(df: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows whose customer is not in the dimension."""
    return df.join(customers.select("customer_id"), "customer_id", "left_anti")


def attach_rate(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Latest rate per currency; a missing rate means the amount is already EUR."""
    rates = rates.select("currency", F.col("rate_to_eur").cast("decimal(10,6)").alias("exchange_rate"))
    return _convert(df.join(rates, "currency", "left"))


def attach_dated_rate(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Rate of exactly the transaction's currency and date."""
    rates = rates.select(
        "currency",
        F.col("date").alias("transaction_date"),
        F.col("rate_to_eur").cast("decimal(10,6)").alias("exchange_rate"),
    )
    return _convert(df.join(rates, ["currency", "transaction_date"], "left"))


def attach_rate_as_of(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Latest rate on or before the transaction date.

    The sparse rate table is filled to one row per currency and day up to the
    newest rate, so the look-up is a plain two-key equi-join; transactions after
    that day use that day's rates.
    """
    newest = F.lit(rates.agg(F.max("date")).first()[0])
    following = F.lead("date").over(Window.partitionBy("currency").orderBy("date"))
    daily = (
        rates.withColumn("__to", F.coalesce(F.date_sub(following, 1), newest))
        .select(
            "currency",
            F.explode(F.sequence("date", "__to")).alias("__rate_date"),
            F.col("rate_to_eur").cast("decimal(10,6)").alias("exchange_rate"),
        )
    )
    dated = df.withColumn("__rate_date", F.least("transaction_date", newest))
    return _convert(dated.join(daily, ["currency", "__rate_date"], "left").drop("__rate_date"))


def _convert(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "amount_eur": to_eur(F.col("amount"), F.col("exchange_rate")),
            "fx_missing": F.col("exchange_rate").isNull(),
        }
    )


def attach_country(
    df: DataFrame,
    risk_countries: DataFrame,
    countries: DataFrame | None = None,
    column: str = "transaction_country",
) -> DataFrame:
    """Normalised country code and name, and whether the country is listed."""
    listed = risk_countries.select(
        F.col("country_code").alias("transaction_country_code"),
        F.col("country_name").alias("__listed_name"),
    )
    df = df.withColumn(
        "transaction_country_code", F.coalesce(F.upper(F.trim(F.col(column))), F.lit(UNKNOWN))
    ).join(listed, "transaction_country_code", "left")
    names = [F.col("__listed_name")]
    if countries is not None:
        known = countries.select(
            F.col("country_code").alias("transaction_country_code"),
            F.col("country_name").alias("__known_name"),
        )
        df = df.join(known, "transaction_country_code", "left")
        names.insert(0, F.col("__known_name"))
    return df.withColumns(
        {
            "transaction_country_name": F.coalesce(*names, F.lit(UNKNOWN)),
            "is_high_risk_country": F.col("__listed_name").isNotNull(),
        }
    ).drop("__listed_name", "__known_name")


def add_calendar(df: DataFrame) -> DataFrame:
    ts = F.col("transaction_timestamp")
    return df.withColumns(
        {
            "transaction_date": F.to_date(ts),
            "transaction_hour": F.hour(ts),
            "day_of_week": F.dayofweek(ts),
        }
    )


def add_flags(df: DataFrame, cfg: RuleConfigA) -> DataFrame:
    """Value, time and locality flags of an enriched transaction."""
    return df.withColumns(
        {
            "is_high_value": F.col("amount_eur") >= F.lit(cfg.high_value_threshold_eur),
            "is_unusual_time": flags.unusual_hour(
                F.col("transaction_hour"), cfg.unusual_from_hour, cfg.unusual_until_hour
            ),
            "business_day_flag": flags.business_day(F.col("transaction_timestamp")),
            # A missing country, which stands as UNKNOWN, says nothing about abroad.
            "is_international": flags.is_true(
                (F.col("transaction_country_code") != F.col("customer_country_code"))
                & (F.col("transaction_country_code") != UNKNOWN)
            ),
        }
    )


def to_silver(df: DataFrame, processed_at: Column) -> DataFrame:
    """The declared silver columns, in order, with their declared types."""
    present = set(df.columns)
    typed = {}
    for field in S.SILVER_TRANSACTIONS.fields:
        if field.name == "channel":
            value = F.coalesce(F.col("channel"), F.lit(UNKNOWN))
        elif field.name == "processing_timestamp":
            value = processed_at
        elif field.name == "value_date" and "value_date" in present:
            value = F.col("value_date").try_cast("date")
        elif field.name in present:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        typed[field.name] = value.cast(field.dataType)
    scored = [n for n in typed if n != "data_quality_score"]
    silver = df.select(*[typed[n].alias(n) for n in scored])
    return silver.withColumn("data_quality_score", flags.null_share_score(scored))
