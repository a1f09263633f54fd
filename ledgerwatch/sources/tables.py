"""Batch tables on shared storage. ``fmt`` is any Spark table format."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DYNAMIC = ("partitionOverwriteMode", "dynamic")


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Read by path; ``merge_schema`` unites the columns of all files."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: tuple[str, ...], fmt: str = "parquet"
) -> None:
    """Replace only the partitions that ``df`` contains."""
    df.write.format(fmt).mode("overwrite").option(*_DYNAMIC).partitionBy(*partition_by).save(path)


def create_if_missing(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
) -> DataFrame:
    """Empty table with the given schema, unless the path already has one."""
    empty = spark.createDataFrame([], schema)
    empty.write.format(fmt).mode("ignore").partitionBy(*partition_by).save(path)
    return read_table(spark, path, fmt, schema)


def dated_path(base: str, label: str, day: date, name: str = "") -> str:
    """``base/label=YYYY-MM-DD[/name]``."""
    path = f"{base.rstrip('/')}/{label}={day.isoformat()}"
    return f"{path}/{name}" if name else path


def write_reports(frames: dict[str, DataFrame], base: str, label: str, day: date) -> dict[str, str]:
    """Write each report frame under its dated folder; re-runs replace it."""
    paths = {}
    for name, frame in frames.items():
        paths[name] = dated_path(base, label, day, name)
        frame.write.mode("overwrite").parquet(paths[name])
    return paths


def evolve(df: DataFrame, other: DataFrame) -> DataFrame:
    """Union by name; a column missing on either side is NULL there."""
    return df.unionByName(other, allowMissingColumns=True)


def table_health(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Row count and GOOD/BAD per table; a table that cannot be opened is BAD."""
    result = None
    for name, path in tables.items():
        try:
            counted = read_table(spark, path, fmt).agg(F.count("*").alias("row_count"))
            health, error = "GOOD", F.lit(None).cast("string")
        except AnalysisException as problem:
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
            health, error = "BAD", F.lit(problem.getCondition())
        row = counted.select(
            F.lit(name).alias("table_name"), "row_count", F.lit(health).alias("health"), error.alias("error")
        )
        result = row if result is None else result.unionByName(row)
    if result is None:
        raise ValueError("no tables given")
    return result


def require_healthy(health: DataFrame) -> None:
    bad = [r["table_name"] for r in health.filter("health = 'BAD'").select("table_name").collect()]
    if bad:
        raise RuntimeError("unhealthy tables: " + ", ".join(bad))
