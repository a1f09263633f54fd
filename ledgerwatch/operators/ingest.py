"""From messages to typed, validated, unique transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.money import parse_amount
from .grouping import keep_latest


def parse_messages(
    raw: DataFrame,
    schema: T.StructType = S.MESSAGE_SCHEMA,
    ingested_at: Column | None = None,
    metadata: bool = True,
) -> DataFrame:
    """Decode the JSON ``value`` of each message into columns.

    Broken JSON gives a row of NULLs, which ``contract_violations`` reports.
    Broker metadata (partition, offset, timestamp) is kept when present.
    """
    carried = [
        F.col(source).alias(target)
        for source, target in (
            ("partition", "kafka_partition"),
            ("offset", "kafka_offset"),
            ("timestamp", "kafka_timestamp"),
        )
        if metadata and source in raw.columns
    ]
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    # ``inline`` decodes each message exactly once: with a plain field access, a
    # later filter would be pushed below it together with copies of the decoder.
    decoded = F.inline(F.array(F.from_json(F.col("value").cast("string"), nullable)))
    return raw.select(decoded, *carried).withColumns(
        {"ingestion_timestamp": stamp, "ingestion_date": F.to_date(stamp)}
    )


def parse_evolving(raw: DataFrame, schema: T.StructType, rest: str = "other_fields") -> DataFrame:
    """Decode JSON messages of several generations into one table without losing a field.

    Fields of ``schema`` become columns, converted where the message has them in
    another type. ``rest`` is a variant of all others: unknown fields, and known ones
    whose value does not convert; null if there are none. ``unparsed`` is the whole text of
    a message that is no JSON object. A JSON null is a missing value.
    """
    if {rest, "unparsed"} & set(schema.names):
        raise ValueError(f"the message schema has a field named {rest} or unparsed")
    text = F.col("value").cast("string")
    opened = raw.select(text.alias("__text"), F.try_parse_json(text).alias("__doc"))
    parts = opened.withColumn("__parts", F.expr("try_cast(__doc AS map<string,variant>)"))
    whole = F.when(F.col("__parts").isNotNull(), F.col("__doc"))
    typed = parts.withColumns(
        {f.name: F.try_variant_get(whole, f"$['{f.name}']", f.dataType.simpleString()) for f in schema.fields}
    )
    placed = F.array_compact(F.array(*[F.when(F.col(f.name).isNotNull(), F.lit(f.name)) for f in schema.fields]))
    left = F.map_filter("__parts", lambda name, value: ~F.array_contains(placed, name) & ~F.is_variant_null(value))
    return typed.withColumn("__left", left).select(
        *schema.names,
        F.when(F.size("__left") > 0, F.to_variant_object("__left")).alias(rest),
        F.when(F.col("__parts").isNull(), F.col("__text")).alias("unparsed"),
    )


def generator_to_bronze(messages: DataFrame, source_system: str) -> DataFrame:
    """Map a source/destination message onto the bronze transaction columns.

    The destination country is the transaction country; deposits are credits,
    every other type is a debit.
    """
    credit = F.col("transaction_type").isin("CASH_DEPOSIT", "CHECK_DEPOSIT")
    return messages.select(
        "transaction_id",
        F.lit(None).cast("string").alias("transaction_ref"),
        "customer_id",
        F.lit("UNKNOWN").alias("account_id"),
        F.col("amount").cast("decimal(18,2)").cast("string").alias("amount"),
        "currency",
        F.when(credit, "CREDIT").otherwise("DEBIT").alias("transaction_type"),
        "channel",
        F.col("destination_country").alias("transaction_country"),
        F.col("timestamp").alias("transaction_timestamp"),
        F.lit(source_system).alias("source_system"),
    )


def contract_violations(df: DataFrame, time_column: str = "transaction_timestamp") -> DataFrame:
    """Add ``violations``: the names of the contract clauses a message breaks."""
    source = {name: name for name in S.CONTRACT_REQUIRED} | {"timestamp": time_column}
    amount = parse_amount(F.col("amount").cast("string"))
    clauses: list[tuple[str, Column]] = [
        (f"missing_{name}", F.col(source[name]).isNull()) for name in S.CONTRACT_REQUIRED
    ]
    clauses += [
        ("amount_not_numeric", F.col("amount").isNotNull() & amount.isNull()),
        ("amount_below_minimum", amount < F.lit(S.CONTRACT_MIN_AMOUNT).cast("decimal(18,2)")),
        ("currency_length", F.length("currency") != S.CONTRACT_CURRENCY_LENGTH),
        ("transaction_type_enum", ~F.col("transaction_type").isin(*S.CONTRACT_TRANSACTION_TYPES)),
        ("channel_enum", ~F.col("channel").isin(*S.CONTRACT_CHANNELS)),
        (
            "timestamp_format",
            F.col(time_column).isNotNull() & F.try_to_timestamp(F.col(time_column).cast("string")).isNull(),
        ),
    ]
    named = [F.when(broken, F.lit(name)) for name, broken in clauses]
    return df.withColumn("violations", F.array_compact(F.array(*named)))


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) by the ``violations`` column."""
    clean = F.size("violations") == 0
    return df.filter(clean).drop("violations"), df.filter(~clean)


def type_and_reject(
    bronze: DataFrame, on_bad_amount: str = "drop", time_format: str | None = None
) -> DataFrame:
    """Type amount and time; drop rows without a positive amount or a time."""
    when = F.col("transaction_timestamp").cast("string")
    stamp = F.try_to_timestamp(when, F.lit(time_format)) if time_format else F.try_to_timestamp(when)
    typed = bronze.withColumns(
        {
            "amount": parse_amount(F.col("amount").cast("string"), on_bad_amount),
            "transaction_timestamp": stamp,
        }
    )
    # The "zero" policy keeps unparsable amounts as 0 and rejects only negatives.
    accepted = F.col("amount") > 0 if on_bad_amount == "drop" else F.col("amount") >= 0
    return typed.filter(accepted & F.col("transaction_timestamp").isNotNull())


def recent_only(df: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Keep transactions of the ``days`` before ``as_of``."""
    oldest = as_of - F.make_interval(days=F.lit(days))
    return df.filter(F.col("transaction_timestamp") >= oldest)


def first_copies(df: DataFrame, key: str = "transaction_id", order_by: str = "ingestion_timestamp") -> DataFrame:
    """Keep the first delivered copy of each transaction; rows without an id are kept as they are."""
    tie_break = [F.col(c).asc_nulls_last() for c in sorted(df.columns) if c not in (key, order_by)]
    # Rows without an id are told apart by all they hold.
    own = F.when(F.col(key).isNull(), F.xxhash64(*[F.col(c) for c in df.columns]))
    marked = df.withColumn("__own", own)
    return keep_latest(marked, [key, "__own"], [F.col(order_by).asc_nulls_last(), *tie_break]).drop("__own")


def deduplicate(df: DataFrame, key: str = "transaction_id", order_by: str = "ingestion_timestamp") -> DataFrame:
    """Keep the newest copy of each transaction."""
    tie_break = [F.col(c).desc_nulls_last() for c in sorted(df.columns) if c not in (key, order_by)]
    return keep_latest(df, [key], [F.col(order_by).desc_nulls_last(), *tie_break])
