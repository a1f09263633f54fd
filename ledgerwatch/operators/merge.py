"""Keyed changes: upserts, conditional merges, SCD2 history and change feeds.

Every operator takes the current rows and the incoming rows and returns the new
rows; storing them is the caller's business (see ``sources.snapshots``).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from .grouping import keep_latest

FAR_FUTURE = date(9999, 12, 31)


def unique_on(source: DataFrame, keys: list[str], newer_by: str | None = None) -> DataFrame:
    """One row per key: the newest by ``newer_by``, ties and rows without it by their other columns."""
    rest = [f.name for f in source.schema.fields if f.name not in (*keys, newer_by) and f.dataType.typeName() not in ("map", "variant")]
    first = [F.col(newer_by).desc_nulls_last()] if newer_by else []
    return keep_latest(source, keys, [*first, *[F.col(c).desc_nulls_last() for c in rest], F.lit(0)])


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Matched rows are replaced, new rows added; repeated keys of ``source`` count once."""
    source = unique_on(source, keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Add only the rows whose key is not there yet."""
    return target.unionByName(new_rows(target, source, keys), allowMissingColumns=True)


def new_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``source`` whose key ``target`` does not have."""
    return source.join(target.select(*keys), keys, "left_anti")


def conditional_merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_when: Column | None = None,
    update: dict[str, Column] | None = None,
    insert: dict[str, Column] | None = None,
) -> DataFrame:
    """Merge with a condition and explicit column assignments.

    Expressions refer to ``target.<column>`` and ``source.<column>``. Without
    ``update`` / ``insert`` all columns of the source are taken. Repeated keys of
    ``source`` count once (see ``unique_on``).
    """
    source = unique_on(source, keys)
    columns = target.columns
    shared = [c for c in columns if c in source.columns]
    update = update if update is not None else {c: F.col(f"source.{c}") for c in shared}
    insert = insert if insert is not None else {c: F.col(f"source.{c}") for c in shared}

    t = target.withColumn("__in_target", F.lit(True)).alias("target")
    s = source.withColumn("__in_source", F.lit(True)).alias("source")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"target.{k}") == F.col(f"source.{k}"))
    joined = t.join(s, same, "full_outer")
    in_target = F.col("__in_target").isNotNull()
    matched = in_target & F.col("__in_source").isNotNull()
    updating = matched if update_when is None else matched & F.coalesce(update_when, F.lit(False))
    return joined.select(
        *[
            F.when(~in_target, insert.get(c, F.lit(None)).cast(target.schema[c].dataType))
            .when(updating, update.get(c, F.col(f"target.{c}")).cast(target.schema[c].dataType))
            .otherwise(F.col(f"target.{c}"))
            .alias(c)
            for c in columns
        ]
    )


def newest_wins(target: DataFrame, source: DataFrame, keys: list[str], time_column: str) -> DataFrame:
    """Late-data merge: a row replaces its older version, never its newer one."""
    latest = unique_on(source, keys, time_column)
    newer = F.col(f"source.{time_column}") > F.col(f"target.{time_column}")
    return conditional_merge(target, latest, keys, update_when=newer)


def scd2_apply(
    dimension: DataFrame,
    source: DataFrame,
    keys: list[str],
    tracked: list[str],
    effective: Column,
    end_column: str = "end_date",
    expired_end: Column | None = None,
    open_end: Column | None = None,
) -> DataFrame:
    """New dimension after one change run.

    The current version of a key is closed and a new one opened only when a
    tracked column differs (NULL-safe). History and unchanged rows pass through,
    so applying the same source twice changes nothing. One join, no collect.
    Repeated keys of ``source`` count once (see ``unique_on``).
    """
    source = unique_on(source, keys)
    open_end = F.lit(None) if open_end is None else open_end
    expired_end = effective if expired_end is None else expired_end
    types = {f.name: f.dataType for f in dimension.schema.fields}
    columns = dimension.columns
    housekeeping = ("effective_date", end_column, "is_current")

    old = dimension.filter("is_current").withColumn("__had", F.lit(True)).alias("old")
    new = source.withColumn("__has", F.lit(True)).alias("new")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}"))
    joined = old.join(new, same, "full_outer")

    had, has = F.col("__had").isNotNull(), F.col("__has").isNotNull()
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    closing = had & has & differs

    def old_value(c: str) -> Column:
        if c == end_column:
            return F.when(closing, expired_end.cast(types[c])).otherwise(F.col(f"old.{c}"))
        if c == "is_current":
            return ~closing
        return F.col(f"old.{c}")

    def new_value(c: str) -> Column:
        if c == "effective_date":
            return effective.cast(types[c])
        if c == end_column:
            return open_end.cast(types[c])
        if c == "is_current":
            return F.lit(True)
        return F.col(f"new.{c}") if c in source.columns else F.lit(None)

    def row(value) -> Column:
        return F.struct(*[value(c).cast(types[c]).alias(c) for c in columns])

    assert all(c in columns for c in housekeeping), "dimension lacks SCD2 columns"
    versions = F.array_compact(
        F.array(F.when(had, row(old_value)), F.when(has & (~had | differs), row(new_value)))
    )
    current = joined.select(F.explode(versions).alias("row")).select("row.*")
    return dimension.filter(~F.col("is_current")).unionByName(current)


def scd2_start(source: DataFrame, effective: Column, end_column: str = "end_date") -> DataFrame:
    """First load: every source row is the current version."""
    return source.withColumns(
        {
            "effective_date": effective,
            end_column: F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )


def scd2_risk_category(
    dimension: DataFrame, profiles: DataFrame, as_of: date
) -> DataFrame:
    """Daily profile run: version customers whose risk category changed.

    Closed versions end the day before ``as_of``; open ones end 9999-12-31.
    """
    return scd2_apply(
        dimension,
        profiles,
        keys=["customer_id"],
        tracked=["risk_category"],
        effective=F.lit(as_of),
        end_column="expiration_date",
        expired_end=F.date_sub(F.lit(as_of), 1),
        open_end=F.lit(FAR_FUTURE),
    )


def current_rows(dimension: DataFrame) -> DataFrame:
    return dimension.filter("is_current")


def as_of_rows(dimension: DataFrame, day: Column, end_column: str = "end_date") -> DataFrame:
    """Versions valid on ``day``; an open end never expires."""
    return dimension.filter(
        day.between(F.col("effective_date"), F.coalesce(F.col(end_column), F.lit(FAR_FUTURE)))
    )


def with_surrogate_key(dimension: DataFrame, name: str, *parts: str) -> DataFrame:
    return dimension.withColumn(name, surrogate_key(*[F.col(p) for p in parts]))


def change_feed(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Row-level changes between two versions of a table.

    ``_change_type`` is insert, delete, update_preimage or update_postimage.
    """
    columns = before.columns
    rest = [c for c in columns if c not in keys]
    b = before.withColumn("__in_before", F.lit(True)).alias("before")
    a = after.withColumn("__in_after", F.lit(True)).alias("after")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}"))
    joined = b.join(a, same, "full_outer")
    was, now = F.col("__in_before").isNotNull(), F.col("__in_after").isNotNull()
    differs = F.lit(False)
    for c in rest:
        differs = differs | ~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}"))

    def image(side: str, kind: Column) -> Column:
        return F.struct(kind.alias("_change_type"), *[F.col(f"{side}.{c}").alias(c) for c in columns])

    pre = F.when(was & (~now | differs), image("before", F.when(now, "update_preimage").otherwise("delete")))
    post = F.when(now & (~was | differs), image("after", F.when(was, "update_postimage").otherwise("insert")))
    return joined.select(F.explode(F.array_compact(F.array(pre, post))).alias("row")).select("row.*")
