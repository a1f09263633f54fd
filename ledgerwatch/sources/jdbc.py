"""Warehouse tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str
    password: str
    driver: str

    def options(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}


@dataclass(frozen=True)
class ReadSplit:
    """Parallel read: ``partitions`` range queries over a numeric or date column."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
        }


def read_options(target: JdbcTarget, query: str, alias: str, split: ReadSplit | None = None) -> dict[str, str]:
    """Options for reading a subquery, which the database evaluates."""
    options = {**target.options(), "dbtable": f"({query}) AS {alias}"}
    return options if split is None else {**options, **split.options()}


def write_options(target: JdbcTarget, table: str, batch_rows: int = 10_000) -> dict[str, str]:
    return {**target.options(), "dbtable": table, "batchsize": str(batch_rows)}


def read_current_customers(
    spark: SparkSession, target: JdbcTarget, split: ReadSplit | None = None
) -> DataFrame:
    query = "SELECT * FROM dim_customer WHERE is_current = TRUE"
    return spark.read.format("jdbc").options(**read_options(target, query, "current_customers", split)).load()


def append(df: DataFrame, target: JdbcTarget, table: str) -> None:
    df.write.format("jdbc").options(**write_options(target, table)).mode("append").save()


def replace(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Refill a staging table."""
    options = {**write_options(target, table), "truncate": "true"}
    df.write.format("jdbc").options(**options).mode("overwrite").save()
