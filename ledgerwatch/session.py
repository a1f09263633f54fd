"""Session settings the engine relies on, and its shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Result-relevant and skew-relevant runtime settings. They can be applied to a
# session somebody else created because all of them are runtime-settable.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when the plan above then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "ledgerwatch",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, which a cluster names.

    Where it is unset, as in a test, a folder under the session's warehouse,
    which the driver and all executors share by definition.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return named.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A new sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

