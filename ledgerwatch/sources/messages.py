"""Message streams: a broker topic in production, folders of files elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def topic_options(
    servers: str, topic: str, starting: str = "latest", max_per_trigger: int = 10_000, protocol: str = "PLAINTEXT"
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(max_per_trigger),
        "kafka.security.protocol": protocol,
    }


def topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Rows of a broker topic (needs the broker connector on the class path)."""
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    file_filter: str | None = None,
) -> DataFrame:
    """New files of a folder as a stream; the file path stands in for the offset."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_filter is not None:
        reader = reader.option("pathGlobFilter", file_filter)
    return reader.load(path)


def with_source_file(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """Key/value rows as a topic sink expects them."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
