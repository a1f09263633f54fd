"""Profiles of all columns of a table that merge over days, and drift between two of them.

Counts, nulls, minima and maxima are exact. Distinct counts are HyperLogLog
sketches and distributions are KLL sketches, so a profile of a column is a few
kilobytes whatever it describes, and a month's profile is the merge of its days'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .curve import number_of

LG_BUCKETS = 12  # relative standard error of a distinct count: 1.04 / sqrt(2**12), 1.6 %
KLL_SIZE = 400  # rank error of a quantile: under 0.7 % with 99 % confidence
STEPS = 200  # quantiles that drift is measured on: 0.5 % more for each side

_ORDERED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)


def profile(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """One row per group and column, from one pass over the table.

    ``by``, column_name, n_rows, nulls, low and high (as numbers; see ``curve.number_of``),
    keys (HLL sketch), shape (KLL sketch). Columns without an order, as
    arrays, have counts and keys only; maps and variants have counts only. A column of nulls has no shape.
    """
    names = columns or [c for c in df.columns if c not in by]
    measured = df.groupBy(*by).agg(*[_measured(df, c).alias(f"__{i}") for i, c in enumerate(names)])
    every = F.explode(F.array(*[F.col(f"__{i}") for i in range(len(names))]))
    return measured.select(*by, every.alias("p")).select(*by, "p.*").filter("n_rows > 0")


def _measured(df: DataFrame, column: str) -> Column:
    kind, value = df.schema[column].dataType, F.col(column)
    number = number_of(df, column) if isinstance(kind, _ORDERED) else F.lit(None).cast("double")
    hashed = F.lit(None).cast("bigint") if isinstance(kind, (T.MapType, T.VariantType)) else F.xxhash64(value)
    shape = F.kll_sketch_agg_double(number, F.lit(KLL_SIZE))
    return F.struct(
        F.lit(column).alias("column_name"),
        F.count("*").alias("n_rows"),
        F.count_if(value.isNull()).alias("nulls"),
        F.min(number).alias("low"),
        F.max(number).alias("high"),
        F.hll_sketch_agg(F.when(value.isNotNull(), hashed), F.lit(LG_BUCKETS)).alias("keys"),
        F.when(F.count(number) > 0, shape).alias("shape"),
    )


def merge_profiles(profiles: DataFrame, by: list[str]) -> DataFrame:
    """Profiles of coarser groups from those of finer ones."""
    return profiles.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("keys").alias("keys"),
        F.when(F.count("shape") > 0, F.kll_merge_agg_double("shape")).alias("shape"),
    )


def _quantiles(shape: Column, shares: list[float]) -> Column:
    return F.when(shape.isNotNull(), F.kll_sketch_get_quantile_double(shape, F.array(*[F.lit(s) for s in shares])))


def described(profiles: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Sketches as figures: n_distinct (estimate) and the quantiles at ``shares``."""
    return profiles.withColumns(
        {"n_distinct": F.hll_sketch_estimate("keys"), "quantiles": _quantiles(F.col("shape"), list(shares))}
    ).drop("keys", "shape")


def drift(before: DataFrame, after: DataFrame, limit: float = 0.1) -> DataFrame:
    """How far each column's distribution has moved: column_name, distance, null_change, drifted.

    ``distance`` is the Kolmogorov-Smirnov distance, the largest difference between the
    shares of values up to some point, within 0.03 of the exact one; null where either
    side has no shape. ``null_change`` is the change of the share of nulls, exact.
    ``drifted`` if either is over ``limit`` or only one side has the column. One profile row per column is expected.
    """
    shares = [(i + 0.5) / STEPS for i in range(STEPS)]

    def side(profiles: DataFrame, name: str) -> DataFrame:
        return profiles.select(
            "column_name",
            (F.col("nulls") / F.col("n_rows")).alias(f"{name}_nulls"),
            _quantiles(F.col("shape"), shares).alias(f"{name}_points"),
        )

    both = side(before, "before").join(side(after, "after"), "column_name", "full_outer")

    def up_to(points: str, value: Column) -> Column:
        return F.size(F.filter(points, lambda p: p <= value)) / STEPS

    gap = F.transform(
        F.array_union("before_points", "after_points"),
        lambda v: F.abs(up_to("before_points", v) - up_to("after_points", v)),
    )
    distance, change = F.array_max(gap), F.col("after_nulls") - F.col("before_nulls")
    moved = (F.coalesce(distance, F.lit(0.0)) > limit) | (F.abs(change) > limit)
    return both.select(
        "column_name", distance.alias("distance"), change.alias("null_change"), F.coalesce(moved, F.lit(True)).alias("drifted")
    )
