"""Deterministic identifiers: the same input always gets the same key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hex digits always fit a signed 64-bit integer.
_KEY_DIGITS = 15


def alert_id(transaction_id: Column, rule_id: Column) -> Column:
    return F.sha2(F.concat_ws("|", transaction_id, rule_id), 256)


def surrogate_key(*parts: Column) -> Column:
    """BIGINT key from the text of ``parts``; stable across runs and engines."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, _KEY_DIGITS), 16, 10).cast("bigint")


def date_key(day: Column) -> Column:
    """Calendar key YYYYMMDD."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
