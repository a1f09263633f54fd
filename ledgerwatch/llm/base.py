"""What the corpus operators share: stored intermediate tables, folds and text words."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, run_dir

# Words are runs of anything but ASCII white space; only A-Z are folded.
SPACE_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    The lineage ends here: a lost executor costs the tasks it ran, not the plan
    before, and no later action computes the frame again.
    """
    spark = frame.sparkSession
    path = run_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


class Workspace:
    """Stored tables of one computation, all dropped once its result is stored elsewhere."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = run_dir(spark, label)
        self.tables = 0

    def stored(self, frame: DataFrame, label: str) -> DataFrame:
        self.tables += 1
        path = f"{self.base}/{self.tables:03d}-{label}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def is_held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def may_learn(doc_id: Column) -> Column:
    """Rows a model may learn from: not held out, and with an id to tell."""
    return doc_id.isNotNull() & ~is_held_out(doc_id)


def slices(texts: list[str | None], limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` characters; a longer text is a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def give_back() -> None:
    """Returns memory that a worker has freed to the system, so that what runs there next finds it.

    Spark keeps Python workers for later tasks; their heap stays as large as it ever was.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives memory back when its task is through."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return inner


def small_batches(spark: SparkSession) -> None:
    """Batches of at most 4 MB between Spark and Python; a longer row is a batch of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def with_columns(batch: pa.RecordBatch, extra: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns put last."""
    return pa.RecordBatch.from_arrays([*batch.columns, *extra.values()], names=[*batch.schema.names, *extra])


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments, zero for empty ones; starts has one more entry, the end."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]
