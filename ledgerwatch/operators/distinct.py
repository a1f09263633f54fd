"""Exact distinct counts that merge: bitmaps of numbered keys.

A distinct count of a month cannot be had from those of its days, but it can be
had from their members. Keys are numbered densely once; the members of a day
are one bitmap for each 32,768 numbers, and any longer period is an OR of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_keys(keys: DataFrame, key: str, known: DataFrame | None = None, buckets: int = 1024) -> DataFrame:
    """``key`` and ``key_number`` for every distinct key that is not null, with those of ``known`` unchanged.

    Keys are counted on within their hash bucket, so numbers are dense but for
    what buckets differ in size, no task sees all keys, and the keys of a later
    load get the numbers that come next. ``buckets`` must stay the same for
    one numbering; a bucket is one task's group, so take one for every 10,000
    keys or so that are expected.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    fresh = keys.filter(F.col(key).isNotNull()).select(key).distinct()
    if known is not None:
        fresh = fresh.join(known.select(key), key, "left_anti")
    counted = fresh.withColumn("__bucket", bucket).withColumn(
        "__at", F.row_number().over(Window.partitionBy("__bucket").orderBy(key))
    )
    taken = F.lit(0)
    if known is not None:
        used = known.groupBy(bucket.alias("__bucket")).agg(F.count("*").alias("__used"))
        counted = counted.join(used, "__bucket", "left")
        taken = F.coalesce(F.col("__used"), F.lit(0))
    number = (taken + F.col("__at") - 1) * buckets + F.col("__bucket")
    numbered = counted.select(key, number.cast("bigint").alias("key_number"))
    return numbered if known is None else known.select(key, "key_number").unionByName(numbered)


def members(df: DataFrame, number: str, by: list[str]) -> DataFrame:
    """The distinct numbers of each group as bitmaps: ``by``, block, members (4 KB a row).

    Bitmaps are built before the shuffle, so a frequent key costs a task one bit. Rows without
    a number have no member.
    """
    return (
        df.filter(F.col(number).isNotNull())
        .groupBy(*by, F.bitmap_bucket_number(F.col(number)).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias("members"))
    )


def merge_members(parts: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of a group that several loads have added to."""
    return parts.groupBy(*by, "block").agg(F.bitmap_or_agg("members").alias("members"))


def count_members(parts: DataFrame, by: list[str]) -> DataFrame:
    """``n_distinct`` of each group, whatever finer groups or loads the bitmaps are of."""
    return merge_members(parts, by).groupBy(*by).agg(F.sum(F.bitmap_count("members")).alias("n_distinct"))


def rolling_distinct(parts: DataFrame, day: str, days: int, by: list[str] | None = None) -> DataFrame:
    """Distinct members of the ``days`` days that end with each day, up to the last day of the table.

    Only bitmaps are repeated, ``days`` times each, never rows. A day without
    any member in its frame has no row.
    """
    by = by or []
    daily = merge_members(parts, [*by, day])
    last = parts.agg(F.max(day)).first()[0]
    later = F.explode(F.sequence(F.col(day), F.least(F.date_add(day, days - 1), F.lit(last).cast("date"))))
    return count_members(daily.withColumn(day, later), [*by, day])
