"""Z-order: rows that are close in several columns come close in one order.

A table sorted by one column after the other can only skip files by the first.
Here every column is ranked by its own quantiles, the bits of the ranks are
interleaved, and rows are laid out by the resulting position, so that the
minima and maxima of a file are narrow in each of the columns.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BITS = 62
POSITION = "__curve_position"


def number_of(df: DataFrame, column: str) -> Column:
    """The value as a number of the same order; of a string, its first six bytes."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.BooleanType):
        return value.cast("int").cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    raise TypeError(f"column {column} of type {kind.simpleString()} has no order to cluster by")


def curve_bounds(df: DataFrame, columns: list[str], bits: int, accuracy: int = 10_000) -> dict[str, list[float]]:
    """For each column the values at ``2**bits - 1`` even shares of its rows, in one pass.

    Only these reach the driver, however large the table is. A column without
    any value has no bounds.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(number_of(df, c), shares, accuracy).alias(c) for c in columns]).first()
    return {c: found[c] or [] for c in columns}


def _rank(value: Column, bounds: list[float], bits: int) -> Column:
    """How many bounds are at most the value, by halving; 0 for a missing value."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(2**i) for i in reversed(range(bits))])
    found = F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(F.element_at(table, at + step) <= value, step).otherwise(0)
    )
    return F.when(value.isNull(), 0).otherwise(found)


def with_curve_position(df: DataFrame, columns: list[str], bits: int = 8) -> DataFrame:
    """Adds ``POSITION``: the interleaved bits of the columns' ranks, first column leading."""
    if not columns or len(columns) * bits > MAX_BITS:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not make a position of 1 to {MAX_BITS} bits")
    bounds = curve_bounds(df, columns, bits)
    ranks = [f"__rank_{i}" for i in range(len(columns))]
    ranked = df.withColumns({r: _rank(number_of(df, c), bounds[c], bits) for r, c in zip(ranks, columns, strict=True)})
    placed = [
        F.shiftleft(F.shiftright(F.col(r), bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(ranks) + len(ranks) - 1 - i)
        for bit in range(bits)
        for i, r in enumerate(ranks)
    ]
    return ranked.withColumn(POSITION, reduce(Column.bitwiseOR, placed)).drop(*ranks)


def curve_cluster(
    df: DataFrame, columns: list[str], files: int, partition_by: tuple[str, ...] = (), bits: int = 8
) -> DataFrame:
    """The same rows, dealt to ``files`` tasks by ranges of curve positions and sorted by them.

    A position that holds very many rows, as that of a frequent value does, is
    cut further by a hash of the row, so it does not end in one file.
    """
    kept = df.columns
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    placed = with_curve_position(df, columns, bits)
    dealt = placed.repartitionByRange(files, *partition_by, POSITION, F.xxhash64(*hashed))
    return dealt.sortWithinPartitions(*partition_by, POSITION).select(*kept)


@dataclass(frozen=True)
class Span:
    """Rows whose column lies between two values, both included."""

    name: str
    column: str
    low: object
    high: object


def files_touched(table: DataFrame, spans: list[Span]) -> DataFrame:
    """For each span the table's files, those that minima and maxima do not rule out, and its rows.

    ``table`` is a frame read from files. An empty one gives no file and no row.
    """
    columns = sorted({s.column for s in spans})
    inside = {s.name: F.col(s.column).between(F.lit(s.low), F.lit(s.high)) for s in spans}
    per_file = table.groupBy(F.col("_metadata.file_path").alias("__file")).agg(
        *[F.min(c).alias(f"__min_{c}") for c in columns],
        *[F.max(c).alias(f"__max_{c}") for c in columns],
        *[F.count_if(inside[s.name]).alias(f"__rows_{s.name}") for s in spans],
    )
    one = per_file.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(s.name).alias("span"),
                        ((F.col(f"__min_{s.column}") <= F.lit(s.high)) & (F.col(f"__max_{s.column}") >= F.lit(s.low))).alias("hit"),
                        F.col(f"__rows_{s.name}").alias("found"),
                    )
                    for s in spans
                ]
            )
        ).alias("f")
    )
    return one.groupBy("f.span").agg(
        F.count("*").alias("files"), F.count_if("f.hit").alias("files_touched"), F.sum("f.found").alias("rows_found")
    )
