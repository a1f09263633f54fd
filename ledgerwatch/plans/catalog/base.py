"""What a registered query is."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ...session import configure
from .inputs import Inputs


@dataclass(frozen=True)
class Entry:
    """``build`` makes the Spark frame; ``sql`` is its equivalent, if SQL can say it."""

    build: Callable[[Inputs], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Inputs(configure(spark), sf_dir))
