"""Boolean and calendar features of one transaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def any_true(flags: list[Column]) -> Column:
    result = F.lit(False)
    for flag in flags:
        result = result | is_true(flag)
    return result


def unusual_hour(hour: Column, from_hour: int, until_hour: int) -> Column:
    """Night hours: at or after ``from_hour``, or before ``until_hour``."""
    return (hour >= from_hour) | (hour < until_hour)


def strictly_after_or_early(hour: Column, after_hour: int, until_hour: int) -> Column:
    """Night hours of the second rule pack: hour 22 itself is not unusual."""
    return (hour < until_hour) | (hour > after_hour)


def business_day(ts: Column) -> Column:
    """Monday to Friday; Spark numbers the days from Sunday = 1."""
    return F.dayofweek(ts).between(2, 6)


def amount_ratio(amount: Column, average: Column) -> Column:
    """Amount over the customer's average; 0 without a positive average."""
    return F.when(average > 0, amount.cast("double") / average.cast("double")).otherwise(F.lit(0.0))


def null_share_score(columns: list[str]) -> Column:
    """Share of the named columns that are filled, as DECIMAL(3,2)."""
    nulls = " + ".join(f"CAST(`{name}` IS NULL AS INT)" for name in columns)
    n = len(columns)
    return F.expr(f"CAST(({n} - ({nulls})) / {n} AS DECIMAL(3,2))")


def account_age_days(as_of: Column, opened: Column) -> Column:
    return F.datediff(as_of, opened)
