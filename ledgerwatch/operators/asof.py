"""As-of look-up by carrying versions forward in time.

An equi-join on the key with a range filter pairs every row with every version
of its key before it drops all but one. Here versions and rows go through one
ordered pass per key and time slice, in which the last version seen is kept; what a slice
starts with is carried over from the slices before it. So the work does not
depend on how many versions a key has, and a busy key is split by time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CARRIED, VERSION, ROW = 0, 1, 2


def last_version(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    since: str,
    payload: list[str],
    slice_hours: int = 24,
) -> DataFrame:
    """Each row with ``payload`` of the newest version of its key that began at or before ``at``.

    A version that begins at the instant of a row counts for it. Of versions that
    begin at the same instant the one with the largest payload counts. Payload is
    null before the first version, for a key without versions, and for a row without key or
    time; versions without key or beginning are left out. Each row comes out once.
    """
    clash = set(payload) & set(rows.columns)
    if clash:
        raise ValueError(f"columns are in both tables: {sorted(clash)}")
    kept = rows.columns
    known = F.col(key).isNotNull() & F.col(at).isNotNull()

    def placed(df: DataFrame, moment: str, kind: int, **more: Column) -> DataFrame:
        instant = F.unix_micros(F.col(moment).cast("timestamp"))
        return df.select(
            F.col(key).alias("key"),
            F.floor(instant / F.lit(slice_hours * 3_600_000_000)).cast("bigint").alias("slice"),
            instant.alias("at"),
            F.lit(kind).alias("kind"),
            *[value.alias(name) for name, value in more.items()],
        )

    usable = versions.filter(F.col(key).isNotNull() & F.col(since).isNotNull())
    version = placed(usable, since, VERSION, v=F.struct(*payload))
    version = version.groupBy("key", "slice", "at", "kind").agg(F.max("v").alias("v"))
    row = placed(rows.filter(known), at, ROW, r=F.struct(*kept))

    # Per key and slice: the last version within it, and whether rows wait for one.
    lasts = version.groupBy("key", "slice").agg(F.max_by("v", "at").alias("v"), F.lit(False).alias("waits"))
    waiting = row.groupBy("key", "slice").agg(F.lit(True).alias("waits"))
    slices = lasts.unionByName(waiting, allowMissingColumns=True)
    slices = slices.groupBy("key", "slice").agg(F.max("v").alias("v"), F.max("waits").alias("waits"))
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn("v", F.last("v", ignorenulls=True).over(earlier)).filter("waits AND v IS NOT NULL")
    start = carried.select("key", "slice", F.lit(None).cast("bigint").alias("at"), F.lit(CARRIED).alias("kind"), "v")

    every = row.unionByName(version.unionByName(start), allowMissingColumns=True)
    so_far = Window.partitionBy("key", "slice").orderBy(F.col("at").asc_nulls_first(), "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = every.withColumn("v", F.last("v", ignorenulls=True).over(so_far)).filter(F.col("kind") == ROW)
    found = found.select("r.*", *[F.col("v").getField(p).alias(p) for p in payload])
    return found.unionByName(rows.filter(~known), allowMissingColumns=True)
