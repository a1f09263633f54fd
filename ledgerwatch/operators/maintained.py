"""Stored aggregates kept up from a change feed instead of being computed anew.

Counts and sums of the changed rows are added to or taken from the stored ones.
A maximum only has to be looked up again in the base table where the largest
value of a group was taken away and nothing as large came in. Only partitions
with changed groups are read and written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import run_dir
from ..sources.tables import overwrite_partitions

ARRIVED = ("insert", "update_postimage")


@dataclass(frozen=True)
class Aggregates:
    """Groups and what is kept of each: ``n_rows``, ``sum_<column>``, ``max_<column>``.

    ``partition`` is one of ``keys``. Sums leave out nulls and are 0 where there is no value.
    """

    keys: tuple[str, ...]
    partition: str
    sums: tuple[str, ...] = ()
    maxima: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.partition not in self.keys:
            raise ValueError(f"partition column {self.partition} is no key")

    @property
    def columns(self) -> list[str]:
        return [*self.keys, "n_rows", *[f"sum_{c}" for c in self.sums], *[f"max_{c}" for c in self.maxima]]


def _sum_type(df: DataFrame, column: str) -> T.DataType:
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, kind.scale)
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return T.LongType()
    raise TypeError(f"sums of {column} ({kind.simpleString()}) cannot be taken back exactly")


def computed(base: DataFrame, spec: Aggregates, feed_id: int = 0) -> DataFrame:
    """The aggregates from the whole base table: first load, and what upkeep has to equal."""
    return base.groupBy(*spec.keys).agg(
        F.count("*").alias("n_rows"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast(_sum_type(base, c)).alias(f"sum_{c}") for c in spec.sums],
        *[F.max(c).alias(f"max_{c}") for c in spec.maxima],
        F.lit(feed_id).cast("bigint").alias("feed_id"),
    )


def changes(feed: DataFrame, spec: Aggregates) -> DataFrame:
    """What a feed does to each group; taken together before the shuffle."""
    came = F.col("_change_type").isin(*ARRIVED)
    sign = F.when(came, 1).otherwise(-1)
    return feed.groupBy(*spec.keys).agg(
        F.sum(sign).alias("n_rows"),
        *[F.coalesce(F.sum(F.col(c) * sign), F.lit(0)).cast(_sum_type(feed, c)).alias(f"sum_{c}") for c in spec.sums],
        *[F.max(F.when(came, F.col(c))).alias(f"came_{c}") for c in spec.maxima],
        *[F.max(F.when(~came, F.col(c))).alias(f"left_{c}") for c in spec.maxima],
    )


def _merged(stored: DataFrame, delta: DataFrame, spec: Aggregates, feed_id: int) -> DataFrame:
    """Stored groups with their changes, and ``__again`` where a maximum has to be looked up."""
    added = ["n_rows", *[f"sum_{c}" for c in spec.sums]]
    renamed = delta.withColumnsRenamed({c: f"__d_{c}" for c in added})
    both = stored.unionByName(renamed, allowMissingColumns=True)
    joined = both.groupBy(*spec.keys).agg(*[F.max(c).alias(c) for c in both.columns if c not in spec.keys])
    # A group that has had this feed already, before a restart, keeps what it has.
    due = F.coalesce(F.col("feed_id"), F.lit(-1)) < feed_id

    def plus(name: str) -> Column:
        change = F.when(due, F.coalesce(F.col(f"__d_{name}"), F.lit(0))).otherwise(0)
        return (F.coalesce(F.col(name), F.lit(0)) + change).cast(stored.schema[name].dataType).alias(name)

    again, largest = F.lit(False), []
    for c in spec.maxima:
        old, came, left = F.col(f"max_{c}"), F.col(f"came_{c}"), F.col(f"left_{c}")
        lost = due & left.isNotNull() & (left >= old) & ~F.coalesce(came >= left, F.lit(False))
        again = again | F.coalesce(lost, F.lit(False))
        largest.append(F.when(due, F.greatest(old, came)).otherwise(old).alias(f"max_{c}"))
    touched = F.col("__d_n_rows").isNotNull()
    mark = F.when(due & touched, feed_id).otherwise(F.col("feed_id")).cast("bigint").alias("feed_id")
    return joined.select(*spec.keys, *[plus(n) for n in added], *largest, mark, again.alias("__again"))


def apply_feed(path: str, feed: DataFrame, base: DataFrame, spec: Aggregates, feed_id: int, spread: int = 4) -> None:
    """Bring the aggregates stored at ``path`` up to ``base``, the table after the changes of ``feed``.

    ``feed_id`` grows from feed to feed; a feed that is applied again, whole or after a
    crash between two partitions, changes nothing more. Groups without rows
    stay as zeros, so a partition that loses all its rows is replaced too; ``current`` leaves them out. A partition is written by up to ``spread`` tasks, one file each.
    """
    spark = base.sparkSession
    work = run_dir(spark, "maintained")
    changes(feed, spec).write.parquet(f"{work}/delta")
    delta = spark.read.parquet(f"{work}/delta")
    stored = spark.read.parquet(path)
    affected = _only(stored, delta, (spec.partition,))
    _merged(affected, delta, spec, feed_id).write.parquet(f"{work}/merged")
    merged = spark.read.parquet(f"{work}/merged")
    result = merged.drop("__again")
    if spec.maxima:
        lost = merged.filter("__again AND n_rows > 0")
        fresh = _only(base, lost, spec.keys).groupBy(*spec.keys).agg(*[F.max(c).alias(f"max_{c}") for c in spec.maxima])
        rest = merged.filter("NOT __again OR n_rows = 0").drop("__again")
        found = lost.drop("__again", *[f"max_{c}" for c in spec.maxima])
        names = [F.col(k).eqNullSafe(F.col(f"__fresh_{k}")) for k in spec.keys]
        found = found.join(fresh.withColumnsRenamed({k: f"__fresh_{k}" for k in spec.keys}), names, "left")
        result = rest.unionByName(found.select(*rest.columns))
    empty = F.col("n_rows") == 0
    result = result.withColumns({f"max_{c}": F.when(~empty, F.col(f"max_{c}")) for c in spec.maxima})
    dealt = result.repartition(spec.partition, F.pmod(F.xxhash64(*spec.keys), F.lit(spread)))
    overwrite_partitions(dealt.select(*stored.columns), path, (spec.partition,))


def current(table: DataFrame, spec: Aggregates) -> DataFrame:
    """Groups that have rows."""
    return table.filter("n_rows > 0").select(*spec.columns)


def _only(df: DataFrame, some: DataFrame, on: tuple[str, ...]) -> DataFrame:
    listed = some.select(*[F.col(c).alias(f"__some_{c}") for c in on]).distinct()
    return df.join(listed, [F.col(c).eqNullSafe(F.col(f"__some_{c}")) for c in on], "left_semi")
