"""Event-time windows and duplicate removal on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LATENESS = "2 hours"


def unique_transactions(
    df: DataFrame, lateness: str = LATENESS, ts: str = "transaction_timestamp", spread: int = 0
) -> DataFrame:
    """Drop repeated transaction ids that arrive within the lateness bound.

    With ``spread``, copies are first reduced within that many groups of input
    partitions, so an id with very many copies is not sent to one task. It
    doubles the state, so it is for sources that repeat themselves heavily.
    """
    marked = df.withWatermark(ts, lateness)
    if spread:
        group = F.pmod(F.spark_partition_id(), F.lit(spread))
        marked = (
            marked.withColumn("__group", group)
            .dropDuplicatesWithinWatermark(["transaction_id", "__group"])
            .drop("__group")
        )
    return marked.dropDuplicatesWithinWatermark(["transaction_id"])


def hourly_totals(
    df: DataFrame,
    lateness: str = LATENESS,
    ts: str = "transaction_timestamp",
    amount: str = "amount_eur",
    keys: tuple[str, ...] = ("customer_id",),
) -> DataFrame:
    """hour_time, keys, hour_amount and hour_count of every hour with rows, once the watermark has passed its end."""
    return (
        df.withWatermark(ts, lateness)
        .groupBy(F.window(ts, "1 hour").alias("hour"), *keys)
        .agg(F.sum(amount).alias("hour_amount"), F.count("*").alias("hour_count"))
        .select(F.window_time("hour").alias("hour_time"), *keys, "hour_amount", "hour_count")
    )


def sliding_totals(
    df: DataFrame,
    lateness: str = LATENESS,
    ts: str = "transaction_timestamp",
    amount: str = "amount_eur",
    keys: tuple[str, ...] = ("customer_id",),
    active_hours: bool = False,
) -> DataFrame:
    """24-hour windows sliding by one hour per customer, or per other ``keys``.

    Two windows in a chain: rows are first added up per customer and hour, and only
    these hours go into the 24 windows they belong to. The hours that a customer was
    active in are the state, not 24 copies of every row. In append mode a window is
    emitted once the watermark has passed its end, which closes all its hours as well.

    ``active_hours`` adds a column of that name: a bit for every hour with rows, at the
    hour's number modulo 24. An hour is added to a window once, so the sum of bits is their union.
    """
    hours = hourly_totals(df, lateness, ts, amount, keys)
    sums = [F.sum("hour_amount").alias("rolling_24h_amount"), F.sum("hour_count").alias("rolling_24h_count")]
    if active_hours:
        bit = F.expr("shiftleft(1L, CAST(pmod(floor(unix_micros(hour_time) / 3600000000), 24) AS INT))")
        sums.append(F.sum(bit).alias("active_hours"))
    return (
        hours.groupBy(F.window("hour_time", "24 hours", "1 hour"), *keys)
        .agg(*sums)
        .withColumn(
            "rolling_24h_avg", F.col("rolling_24h_amount").cast("double") / F.col("rolling_24h_count")
        )
    )


def with_window_totals(
    df: DataFrame,
    lateness: str = LATENESS,
    ts: str = "transaction_timestamp",
    amount: str = "amount_eur",
    salts: int = 8,
    how: str = "left",
) -> DataFrame:
    """Each transaction joined to the totals of every window it falls into.

    A transaction waits once, under its customer and hour, until the last of its 24
    windows has closed; the totals of a closed window go to the customer's active hours
    in it and are not kept. The watermark bounds both: an hour's rows are forgotten a day
    after it. So the largest thing that any task holds is one customer's rows of an hour,
    and a transaction is repeated per window in the output alone.

    With ``how`` left, a row without a customer comes out with nulls once its window is
    closed; inner leaves it out. Such rows close their windows in ``salts`` groups, so
    that they are not one task's. A row that comes after its hour was closed is left out
    on both sides; ``late`` looks after those.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    alone = F.col("customer_id").isNull()
    if how == "inner":
        df = df.filter(~alone)
    group = F.when(alone, F.pmod(F.xxhash64("transaction_id"), F.lit(salts)).cast("int")).otherwise(-1)
    grouped = df.withColumn("__group", group)

    first = F.expr("CAST(floor(unix_micros(window.start) / 3600000000) AS BIGINT)")
    inside = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: F.col("__first") + i),
        lambda hour: F.getbit(F.col("active_hours"), F.pmod(hour, F.lit(24)).cast("int")) == 1,
    )
    totals = (
        sliding_totals(grouped, lateness, ts, amount, ("customer_id", "__group"), active_hours=True)
        .withColumn("__first", first)
        .select(
            F.coalesce(F.col("customer_id").cast("string"), F.lit("")).alias("__who"),
            F.col("__group").alias("__of"),
            F.struct("window.start", "window.end").alias("window"),  # ``__closing`` alone is an event time here
            F.window_time("window").alias("__closing"),
            *[
                F.when(F.col("__group") < 0, F.col(c)).alias(c)
                for c in ("rolling_24h_amount", "rolling_24h_count")
            ],
            F.explode(inside).alias("__in_hour"),
        )
    )
    marked = grouped.withWatermark(ts, lateness).withColumns(
        {
            "__hour_time": F.window_time(F.window(ts, "1 hour")),
            "__hour": F.expr(f"CAST(floor(unix_micros({ts}) / 3600000000) AS BIGINT)"),
            "__key": F.coalesce(F.col("customer_id").cast("string"), F.lit("")),
        }
    )
    # The end of its hour is the only event time that a row brings into the join.
    rows = marked.withColumn(ts, F.col(ts) + F.expr("INTERVAL 0 SECONDS"))
    day = F.expr("INTERVAL 24 HOURS")
    found = rows.join(
        totals,
        (F.col("__key") == F.col("__who"))
        & (F.col("__group") == F.col("__of"))
        & (F.col("__hour") == F.col("__in_hour"))
        & (F.col("__hour_time") <= F.col("__closing"))
        & (F.col("__hour_time") > F.col("__closing") - day),
        "inner",
    )
    others = [c for c in df.columns if c != "customer_id"]
    return found.select("customer_id", "window", *others, "rolling_24h_amount", "rolling_24h_count")
