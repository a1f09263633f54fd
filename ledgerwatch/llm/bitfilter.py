"""A Bloom filter of fixed size over longs: what fails it need not be shuffled.

It has a proven size (``1 << LOG_BITS`` bits) whatever goes in, so it may be sent to
the driver and to every task. Values that pass by chance only cost what they would
have cost without it; a join afterwards is what decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_BITS = 26
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _places(values: np.ndarray) -> np.ndarray:
    """Two bit numbers for each value."""
    values = values.view(np.uint64)
    values = values ^ (values >> np.uint64(32))
    return np.concatenate([(values * m) >> np.uint64(64 - LOG_BITS) for m in _MULTIPLIERS])


def build(frame: DataFrame, column: str) -> np.ndarray:
    """The filter of all values of a long column, as 64-bit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(_places(batch.column(0).to_numpy()))
            word = (places >> np.uint64(6)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), first) if len(word) else places
            yield pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(bits.view(np.int64))], names=["word", "bits"])

    words = frame.select(F.col(column).cast("long")).where(F.col(column).isNotNull()).mapInArrow(run, "word long, bits long")
    gathered = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (LOG_BITS - 6), np.uint64)
    out[gathered.column("word").to_numpy()] = gathered.column("bits").to_numpy().view(np.uint64)
    return out


def passes(filter_: np.ndarray, values: np.ndarray) -> np.ndarray:
    places = _places(values)
    hit = (filter_[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))) & np.uint64(1)
    return (hit[: len(values)] & hit[len(values) :]).astype(bool)


def kept(frame: DataFrame, column: str, filter_: np.ndarray) -> DataFrame:
    """The rows whose long value passes."""
    sent = frame.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(sent.value, batch.column(column).to_numpy())))

    return frame.mapInArrow(run, frame.schema)
