"""Data-quality checks.

All checks of a table are measured in one aggregate, then unfolded into one row
per check, so a suite costs a single pass however many checks it has.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.window import Window

from ..config import QualityConfig

CHECK_COLUMNS = ["table_name", "check_type", "check_name", "metric_value", "metric_percent", "passed"]

# Columns, lists and ranges of the three check suites.
RAW_REQUIRED = ("transaction_id", "customer_id", "amount", "currency", "timestamp")
RAW_CURRENCIES = ("EUR", "USD", "GBP", "CHF", "AED", "RUB", "CNY", "TRY")
RAW_TYPES = (
    "ATM_WITHDRAWAL",
    "POS_PURCHASE",
    "ONLINE_TRANSFER",
    "WIRE_TRANSFER",
    "CHECK_DEPOSIT",
    "CASH_DEPOSIT",
)
ENRICHED_REQUIRED = (
    "transaction_id",
    "customer_id",
    "amount",
    "transaction_risk_score",
    "is_suspicious",
)
PRIORITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
PROFILE_REQUIRED = ("customer_id", "risk_score", "risk_category")
PROFILE_CATEGORIES = ("LOW", "MEDIUM", "HIGH")
KYC_STATUSES = ("APPROVED", "PENDING", "REJECTED")


@dataclass(frozen=True)
class Check:
    """One measurement and the test it has to pass.

    ``measure`` is an aggregate; ``accept`` decides on the measured value.
    ``as_percent`` also reports the value as a share of all rows.
    """

    check_type: str
    name: str
    measure: Column
    accept: Callable[[Column], Column]
    as_percent: bool = False
    required: bool = True


def _none(value: Column) -> Column:
    return value == 0


def completeness(columns: tuple[str, ...]) -> list[Check]:
    return [
        Check("COMPLETENESS", c, F.count_if(F.col(c).isNull()), _none, as_percent=True) for c in columns
    ]


def validity(rules: dict[str, Column]) -> list[Check]:
    """Rows that break a rule; an undecided (NULL) rule is not a breach."""
    return [
        Check("VALIDITY", name, F.count_if(~rule), _none, as_percent=True) for name, rule in rules.items()
    ]


def consistency(columns: list[str]) -> list[Check]:
    """Event time before processing time, positive amount; only where present."""
    checks = []
    if {"transaction_timestamp", "processing_timestamp"} <= set(columns):
        late = F.col("transaction_timestamp") > F.col("processing_timestamp")
        checks.append(Check("CONSISTENCY", "transaction_timestamp_before_processing", F.count_if(late), _none))
    if "amount" in columns:
        checks.append(Check("CONSISTENCY", "positive_amounts", F.count_if(F.col("amount") <= 0), _none))
    return checks


def uniqueness(keys: tuple[str, ...]) -> list[Check]:
    """Rows minus distinct keys; NULL counts as one key."""
    checks = []
    for key in keys:
        distinct = F.count_distinct(F.col(key)) + F.max(F.col(key).isNull().cast("int"))
        checks.append(Check("UNIQUENESS", key, F.count("*") - F.coalesce(distinct, F.lit(0)), _none))
    return checks


def timeliness(column: str, as_of: Column, cfg: QualityConfig) -> list[Check]:
    """Hours since the newest row; no result for an empty table."""
    lag = (F.unix_micros(as_of) - F.unix_micros(F.max(column))) / F.lit(3.6e9)
    return [
        Check("TIMELINESS", "data_freshness", lag, lambda v: v < cfg.freshness_hours, required=False)
    ]


def volume(cfg: QualityConfig) -> list[Check]:
    return [
        Check("VOLUME", "row_count", F.count("*"), lambda v: v.between(cfg.volume_min, cfg.volume_max))
    ]


def run_checks(df: DataFrame, table_name: str, checks: list[Check]) -> DataFrame:
    """One row per check: measured value, share of rows in percent, verdict."""
    measured = df.agg(
        F.count("*").alias("__rows"),
        *[c.measure.cast("double").alias(f"__m{i}") for i, c in enumerate(checks)],
    )
    rows = []
    for i, check in enumerate(checks):
        value = F.col(f"__m{i}")
        share = F.coalesce(F.try_divide(value * 100, F.col("__rows")), F.lit(0.0))
        rows.append(
            F.struct(
                F.lit(table_name).alias("table_name"),
                F.lit(check.check_type).alias("check_type"),
                F.lit(check.name).alias("check_name"),
                F.round(value, 2).alias("metric_value"),
                (F.round(share, 2) if check.as_percent else F.lit(None).cast("double")).alias("metric_percent"),
                check.accept(value).alias("passed"),
                F.lit(check.required).alias("__required"),
            )
        )
    unfolded = measured.select(F.explode(F.array(*rows)).alias("check")).select("check.*")
    return unfolded.filter(F.col("__required") | F.col("metric_value").isNotNull()).select(*CHECK_COLUMNS)


def raw_suite(df: DataFrame, cfg: QualityConfig) -> DataFrame:
    rules = {
        "valid_currency": F.col("currency").isin(*RAW_CURRENCIES),
        "valid_transaction_type": F.col("transaction_type").isin(*RAW_TYPES),
        "positive_amount": F.col("amount") > 0,
    }
    return run_checks(
        df,
        "raw_transactions",
        completeness(RAW_REQUIRED)
        + validity(rules)
        + uniqueness(("transaction_id",))
        + consistency(df.columns)
        + volume(cfg),
    )


def enriched_suite(df: DataFrame) -> DataFrame:
    rules = {
        "risk_score_range": F.col("transaction_risk_score").between(0, 1),
        "valid_priority": F.col("alert_priority").isin(*PRIORITIES),
        "positive_rules": F.col("total_rules_triggered") >= 0,
    }
    return run_checks(
        df,
        "enriched_transactions",
        completeness(ENRICHED_REQUIRED) + validity(rules) + consistency(df.columns),
    )


def profile_suite(df: DataFrame, as_of: Column, cfg: QualityConfig) -> DataFrame:
    rules = {
        "risk_score_range": F.col("risk_score").between(0, 1),
        "valid_risk_category": F.col("risk_category").isin(*PROFILE_CATEGORIES),
        "valid_kyc": F.col("kyc_status").isin(*KYC_STATUSES),
    }
    return run_checks(
        df,
        "customer_profiles",
        completeness(PROFILE_REQUIRED)
        + validity(rules)
        + uniqueness(("customer_id",))
        + timeliness("profile_timestamp", as_of, cfg),
    )


def overall(checks: DataFrame, cfg: QualityConfig) -> DataFrame:
    """Totals, score in percent, and PASS from the pass mark on."""
    return (
        checks.agg(F.count("*").alias("total_checks"), F.count_if("passed").alias("passed_checks"))
        .withColumn("failed_checks", F.col("total_checks") - F.col("passed_checks"))
        .withColumn(
            "__score",
            F.coalesce(F.try_divide(F.col("passed_checks") * 100.0, F.col("total_checks")), F.lit(0.0)),
        )
        .withColumn("quality_score", F.round("__score", 2))
        .withColumn("overall_status", F.when(F.col("__score") >= cfg.pass_score, "PASS").otherwise("FAIL"))
        .drop("__score")
    )


class QualityGateError(RuntimeError):
    """The run must not continue."""


def gate(summary: DataFrame) -> None:
    """Raise unless the one-row overall summary passed."""
    row = summary.first()
    if row is None or row["overall_status"] != "PASS":
        score = None if row is None else row["quality_score"]
        raise QualityGateError(f"quality score {score} is below the pass mark")


def has_at_least(df: DataFrame, rows: int) -> bool:
    """Input-volume gate; stops reading once enough rows were seen."""
    return df.limit(rows).count() >= rows


def completeness_score(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of rows complete in all columns; 0 for an empty table."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return df.agg(
        F.count("*").alias("total_rows"), F.count_if(complete).alias("complete_rows")
    ).withColumn(
        "completeness",
        F.coalesce(
            F.try_divide(F.col("complete_rows").cast("double"), F.col("total_rows").cast("double")),
            F.lit(0.0),
        ),
    )


def profile_sanity(profiles: DataFrame) -> DataFrame:
    average = F.col("avg_transaction_amount_90d")
    return profiles.agg(
        F.count_if(F.col("risk_category").isNull()).alias("null_category_count"),
        F.count_if(F.col("transaction_count_90d") <= 0).alias("invalid_count_count"),
        F.count_if((average < 0) | (average > 1_000_000)).alias("suspicious_average_count"),
    )


def referential_integrity(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows and keys of ``child`` without a parent.

    Child rows are counted per key before the join, so a hot key is one row.
    """
    per_key = child.groupBy(key).agg(F.count("*").alias("__rows"))
    orphans = per_key.join(parent.select(key), key, "left_anti")
    return orphans.agg(
        F.count("*").alias("orphan_keys"), F.coalesce(F.sum("__rows"), F.lit(0)).alias("orphan_rows")
    )


def reconcile(
    left: DataFrame, right: DataFrame, keys: list[str], amount: str
) -> DataFrame:
    """Row counts and sums of two layers per key, and their differences; NULL keys are equal."""

    def totals(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count("*").alias(f"{side}_rows"),
            F.sum(amount).cast("decimal(38,2)").alias(f"{side}_amount"),
        )

    zero = F.lit(0)
    other = totals(right, "right").withColumnsRenamed({k: f"__right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    both = totals(left, "left").join(other, same, "full_outer").withColumns({k: F.coalesce(k, f"__right_{k}") for k in keys})
    both = both.drop(*[f"__right_{k}" for k in keys])
    filled = both.withColumns(
        {c: F.coalesce(F.col(c), zero) for c in ("left_rows", "right_rows", "left_amount", "right_amount")}
    )
    return filled.withColumns(
        {
            "row_difference": F.col("left_rows") - F.col("right_rows"),
            "amount_difference": (F.col("left_amount") - F.col("right_amount")).cast("decimal(38,2)"),
        }
    ).withColumn("reconciled", (F.col("row_difference") == 0) & (F.col("amount_difference") == 0))


def service_levels(
    alerts: DataFrame,
    ingested: str,
    raised: str,
    as_of: Column,
    cfg: QualityConfig,
    quality_score: float | None = None,
) -> DataFrame:
    """95th-percentile ingest-to-alert seconds (exact, in milliseconds), lag of the newest row, verdicts.

    Rows are counted per latency first; what is ordered is one row per millisecond.
    ``quality_score`` is the percentage of the latest quality summary.
    """
    latency = F.floor((F.unix_micros(raised) - F.unix_micros(ingested)) / 1000)
    per_latency = alerts.groupBy(latency.alias("__ms")).agg(F.count("*").alias("__rows"), F.max(raised).alias("__newest"))
    known = F.when(F.col("__ms").isNotNull(), F.col("__rows"))
    upto = F.sum(known).over(Window.orderBy(F.col("__ms").asc_nulls_last()))
    ranked = per_latency.withColumn("__reached", upto >= F.ceil(F.lit(0.95) * F.sum(known).over(Window.partitionBy())))
    return ranked.agg(
        (F.min(F.when(F.col("__reached"), F.col("__ms"))) / F.lit(1000.0)).alias("p95_latency_seconds"),
        ((F.unix_micros(as_of) - F.unix_micros(F.max("__newest"))) / F.lit(6e7)).alias("lag_minutes"),
    ).withColumns(
        {
            "latency_ok": F.col("p95_latency_seconds") < cfg.latency_p95_seconds,
            "lag_ok": F.col("lag_minutes") <= cfg.max_lag_minutes,
            "quality_ok": F.lit(quality_score) >= F.lit(cfg.quality_floor_percent),
        }
    )


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` and its row count, taken while ``df`` is written: no extra job.

    Works on batch frames; streams report theirs to ``streaming.progress``.
    """
    rows = Observation(name)
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def column_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, NULLs, minimum, maximum and mean of numeric columns, one row each."""
    measured = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("filled"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.min(F.col(c).cast("double")).alias("minimum"),
                F.max(F.col(c).cast("double")).alias("maximum"),
                F.avg(F.col(c).cast("double")).alias("mean"),
            ).alias(c)
            for c in columns
        ]
    )
    return measured.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("s")).select("s.*")
