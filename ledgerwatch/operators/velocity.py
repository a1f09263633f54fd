"""Per-customer activity over moving time frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RuleConfigA
from ..functions.money import exact_avg, from_cents, to_cents
from .grouping import join_null_safe

_MICROS_PER_MINUTE = 60_000_000
_MICROS_PER_HOUR = 3.6e9


def trailing_sums(
    df: DataFrame,
    measures: dict[str, Column],
    key: str = "customer_id",
    ts: str = "transaction_timestamp",
    hours: int = 24,
    slice_minutes: int = 10,
    wanted: Column | None = None,
) -> DataFrame:
    """Add the sum of each measure over the trailing frame ``[t - hours, t]``.

    Same result as ``SUM(..) OVER (PARTITION BY key ORDER BY ts RANGE BETWEEN
    hours PRECEDING AND CURRENT ROW)``, without ever gathering a key:

    1. Rows of one key and instant are summed first, before any shuffle, so
       copies and ties collapse to one entry.
    2. The entries are partitioned by (key, time slice). Within a slice the
       trailing sum is one running total over three kinds of entries: the sum of
       the full slices before it (placed at the slice start), plus each entry of
       the slice at its time, minus each entry of the slice one frame earlier,
       placed just after the instant it leaves the frame. A slice holds at most
       one entry per microsecond, and each entry costs O(1).
    3. The rows look their instant up, a plain equi-join that adaptive execution
       splits where it is skewed.

    ``wanted`` limits the output to some rows; the others only contribute.
    """
    slice_us = slice_minutes * _MICROS_PER_MINUTE
    frame_us = hours * 60 * _MICROS_PER_MINUTE
    if frame_us % slice_us:
        raise ValueError("the slice width must divide the frame")

    names = list(measures)
    at = F.unix_micros(F.col(ts)).alias("__at")
    instants = (
        df.filter(F.col(ts).isNotNull())
        .select(key, at, *[measures[n].alias(n) for n in names])
        .groupBy(key, "__at")
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
        .withColumn("__slice", F.expr(f"__at - pmod(__at, {slice_us})"))
    )
    own_and_leaving = instants.withColumn("__own", F.explode(F.array(F.lit(True), F.lit(False)))).selectExpr(
        key,
        "__own",
        f"IF(__own, __at, __at + {frame_us + 1}) AS __at",
        f"IF(__own, __slice, __slice + {frame_us}) AS __slice",
        *[f"IF(__own, {n}, -{n}) AS {n}" for n in names],
    )
    earlier = Window.partitionBy(key).orderBy("__slice").rangeBetween(-frame_us, -1)
    before = (
        instants.groupBy(key, "__slice")
        .agg(*[F.sum(n).alias(n) for n in names])
        .select(
            key,
            F.lit(False).alias("__own"),
            F.col("__slice").alias("__at"),
            "__slice",
            *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names],
        )
    )
    running = (
        Window.partitionBy(key, "__slice")
        .orderBy("__at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    moving = (
        own_and_leaving.unionByName(before)
        .select(key, "__own", "__at", *[F.sum(n).over(running).alias(n) for n in names])
        .filter("__own")
        .drop("__own")
    )
    rows = df if wanted is None else df.filter(wanted)
    return join_null_safe(rows.withColumn("__at", at), moving, [key, "__at"]).drop("__at")


def trailing_velocity(
    df: DataFrame,
    cfg: RuleConfigA,
    slice_minutes: int = 10,
    amount: str = "amount_eur",
    wanted: Column | None = None,
) -> DataFrame:
    """Trailing amount, count, average and just-below-threshold count."""
    near = (F.col(amount) >= F.lit(cfg.structuring_floor_eur)) & (
        F.col(amount) < F.lit(cfg.structuring_ceiling_eur)
    )
    summed = trailing_sums(
        df,
        {
            "rolling_24h_amount": to_cents(F.col(amount)),
            "rolling_24h_count": F.lit(1).cast("bigint"),
            "structuring_24h_count": near.cast("int").cast("bigint"),
        },
        hours=cfg.velocity_window_hours,
        slice_minutes=slice_minutes,
        wanted=wanted,
    )
    return summed.withColumns(
        {
            "rolling_24h_amount": from_cents(F.col("rolling_24h_amount")),
            "rolling_24h_avg": exact_avg(from_cents(F.col("rolling_24h_amount")), F.col("rolling_24h_count")),
        }
    )


def sliding_totals(df: DataFrame, amount: str = "amount_eur") -> DataFrame:
    """24-hour windows sliding by one hour: amount, count and average per customer.

    Rows are first summed per customer and hour; only those sums are copied
    into the 24 windows they belong to.
    """
    hour = F.date_trunc("hour", F.col("transaction_timestamp"))
    hourly = (
        df.groupBy("customer_id", hour.alias("__hour"))
        .agg(F.sum(amount).alias("__amount"), F.count("*").alias("__count"))
    )
    one_hour = F.expr("INTERVAL 1 HOUR")
    first_start = F.col("__hour") - F.expr("INTERVAL 23 HOURS")
    return (
        hourly.withColumn("window_start", F.explode(F.sequence(first_start, F.col("__hour"), one_hour)))
        .groupBy("customer_id", "window_start")
        .agg(
            F.sum("__amount").cast("decimal(38,2)").alias("rolling_24h_amount"),
            F.sum("__count").alias("rolling_24h_count"),
        )
        .withColumns(
            {
                "window_end": F.col("window_start") + F.expr("INTERVAL 24 HOURS"),
                "rolling_24h_avg": exact_avg(F.col("rolling_24h_amount"), F.col("rolling_24h_count")),
            }
        )
    )


def sliding_peak(df: DataFrame, amount: str = "amount_eur") -> DataFrame:
    """Per transaction, the largest amount and count over the windows it is in."""
    span = Window.partitionBy("customer_id").orderBy(F.unix_seconds("window_start"))
    covering = span.rangeBetween(-23 * 3600, Window.currentRow)
    peaks = sliding_totals(df, amount).select(
        "customer_id",
        F.col("window_start").alias("__hour"),
        F.max("rolling_24h_amount").over(covering).alias("peak_24h_amount"),
        F.max("rolling_24h_count").over(covering).alias("peak_24h_count"),
    )
    hour = F.date_trunc("hour", F.col("transaction_timestamp"))
    return (
        df.withColumn("__hour", hour).join(peaks, ["customer_id", "__hour"], "left").drop("__hour")
    )


def daily_velocity(df: DataFrame, cfg: RuleConfigA) -> DataFrame:
    """Daily count per customer against the average of the days before it.

    The baseline is the mean per calendar day since the customer's first active
    day inside the lookback; a customer's first day has none.
    """
    daily = df.groupBy("customer_id", "transaction_date").agg(F.count("*").alias("daily_count"))
    day = F.unix_date("transaction_date")
    past = (
        Window.partitionBy("customer_id").orderBy(day).rangeBetween(-cfg.velocity_baseline_days, -1)
    )
    days = F.datediff(F.col("transaction_date"), F.min("transaction_date").over(past))
    baseline = F.try_divide(F.sum("daily_count").over(past).cast("double"), days)
    return daily.withColumn("baseline_daily_count", baseline).withColumn(
        "is_velocity_anomaly",
        F.coalesce(
            F.col("daily_count") > F.col("baseline_daily_count") * cfg.velocity_multiplier, F.lit(False)
        ),
    )


def attach_velocity_anomaly(df: DataFrame, activity: DataFrame, cfg: RuleConfigA) -> DataFrame:
    """Mark the transactions of anomalous customer-days found in ``activity``.

    Only the anomalous days are joined, which are few by definition.
    """
    anomalies = (
        daily_velocity(activity, cfg)
        .filter("is_velocity_anomaly")
        .select("customer_id", "transaction_date", "is_velocity_anomaly")
    )
    joined = df.join(anomalies, ["customer_id", "transaction_date"], "left")
    return joined.withColumn("is_velocity_anomaly", F.coalesce("is_velocity_anomaly", F.lit(False)))


def _previous_instants(instants: DataFrame, slice_minutes: int) -> DataFrame:
    """Add ``__gap``: hours since the customer's previous instant.

    ``instants`` has one row per customer and ``__at``. They are compared inside
    (customer, time slice) groups; the first of a slice looks at the end of the
    customer's last active slice.
    """
    sliced = instants.withColumn("__slice", F.expr(f"__at - pmod(__at, {slice_minutes * _MICROS_PER_MINUTE})"))
    by_slice = Window.partitionBy("customer_id").orderBy("__slice")
    ends = (
        sliced.groupBy("customer_id", "__slice")
        .agg(F.max("__at").alias("__end"))
        .select("customer_id", "__slice", F.lag("__end").over(by_slice).alias("__previous_end"))
    )
    inside = Window.partitionBy("customer_id", "__slice").orderBy("__at")
    previous = F.coalesce(F.lag("__at").over(inside), F.col("__previous_end"))
    joined = join_null_safe(sliced, ends, ["customer_id", "__slice"])
    return joined.withColumn("__gap", (F.col("__at") - previous) / F.lit(_MICROS_PER_HOUR)).drop(
        "__slice", "__previous_end"
    )


def time_between(
    df: DataFrame, ts: str = "transaction_timestamp", slice_minutes: int = 60
) -> DataFrame:
    """Hours since the customer's previous transaction, one row per transaction.

    Among transactions of one instant the lowest id comes first; the others
    follow it by 0 hours. Transaction ids are expected to be unique.
    """
    keyed = df.withColumn("__at", F.unix_micros(F.col(ts)))
    instants = keyed.groupBy("customer_id", "__at").agg(F.min("transaction_id").alias("__first"))
    gaps = _previous_instants(instants, slice_minutes)
    joined = join_null_safe(keyed, gaps, ["customer_id", "__at"])
    own = F.when(F.col("transaction_id") == F.col("__first"), F.col("__gap")).otherwise(F.lit(0.0))
    return joined.withColumn("hours_since_previous", own).drop("__at", "__first", "__gap")


def gap_statistics(
    df: DataFrame, ts: str = "transaction_timestamp", slice_minutes: int = 60
) -> DataFrame:
    """Mean and sample deviation of the hours between a customer's transactions.

    Transactions of one instant are counted first; all but one of them add a
    gap of 0 hours.
    """
    instants = df.groupBy("customer_id", F.unix_micros(F.col(ts)).alias("__at")).agg(
        F.count("*").alias("__rows")
    )
    gap = F.coalesce(F.col("__gap"), F.lit(0.0))
    totals = (
        _previous_instants(instants, slice_minutes)
        .groupBy("customer_id")
        .agg(
            (F.sum("__rows") - 1).alias("__n"),
            F.sum(gap).alias("__s"),
            F.sum(gap * gap).alias("__q"),
        )
    )
    n, s, q = F.col("__n"), F.col("__s"), F.col("__q")
    variance = F.when(n > 1, F.greatest(F.try_divide(q - s * s / n, n - 1), F.lit(0.0)))
    return totals.select(
        "customer_id",
        F.try_divide(s, n).alias("avg_hours_between_transactions"),
        F.sqrt(variance).alias("stddev_hours_between_transactions"),
    )
