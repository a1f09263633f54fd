"""File layout upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.curve import curve_cluster


def cluster(df: DataFrame, columns: list[str], files: int, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Range-partition and sort, so that files hold narrow value ranges to skip by."""
    order = [*partition_by, *columns]
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)


def compact(
    spark: SparkSession,
    path: str,
    columns: list[str],
    files: int,
    partition_by: tuple[str, ...] = (),
    only: dict[str, list] | None = None,
    target: str | None = None,
    curve_bits: int | None = None,
) -> str:
    """Rewrite a table, or its partitions with the values in ``only``, into few, clustered files.

    In place for partitioned tables: dynamic overwrite swaps whole partitions
    after the new files exist. ``only`` maps partition columns to values, so that
    it cannot select part of a partition. Otherwise the result goes to ``target``.
    With ``curve_bits`` files are laid along a Z-order curve of that many bits a
    column, so that each column alone skips files. Rows are unchanged.
    """
    outside = set(only or {}) - set(partition_by)
    if outside:
        raise ValueError(f"{sorted(outside)} are no partition columns")
    if target is None and not partition_by:
        raise ValueError("an unpartitioned table needs a target path")
    df = spark.read.parquet(path)
    for column, values in (only or {}).items():
        df = df.filter(F.col(column).isin(list(values)))
    destination = target or path
    if curve_bits is None:
        laid_out = cluster(df, columns, files, partition_by)
    else:
        laid_out = curve_cluster(df, columns, files, partition_by, curve_bits)
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(destination)
    )
    return destination
