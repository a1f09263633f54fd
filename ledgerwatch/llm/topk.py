"""Exact top-k search by inner product over a bit-sliced index.

Vectors are dealt to row blocks, queries to query blocks, and every pair of blocks
is one task's work. In a row block each attribute, less its minimum, is quantised to
at most ``slices`` bits and stored as bitmaps over the rows. For a query the bitmaps
of all attributes, at the weights of the query's components, are added by carry-save
adders into the bitmaps of the score's bits. From the most significant of these
downward the k-th score is found, and, less what quantisation can hide, a bitmap of
all rows that may still belong to the first k. Those boundary rows are scored exactly.
Each block gives k rows per query; the best k of all blocks are the result.

Defined results: vectors that are null, or hold null or non-finite components, take
no part; nor do rows without an id. Rows that repeat an id count once (the smallest
vector stays). Components that only the longer of two vectors has count as zero.
Equal scores are ordered by id. A query with fewer than k candidates gets them all.
Scores are 64-bit sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import stored


@dataclass(frozen=True)
class TopKConfig:
    k: int = 5
    scale: float = 256.0
    slices: int = 8
    # Layout only: rows and queries of a block at most.
    rows: int = 65_536
    queries: int = 2_048


def quantised(vectors: DataFrame, config: TopKConfig = TopKConfig()) -> DataFrame:
    """vec_id and the whole numbers floor(scale * x) of every vector that takes part."""

    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    whole = F.transform("embedding", lambda x: F.floor(F.lit(config.scale) * x.cast("double")).cast("long"))
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", usable))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


class SlicedBlock:
    """Bitmaps of a block of rows."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, slices: int):
        self.ids, self.values = ids, values
        rows, width = values.shape
        self.low = values.min(axis=0) if rows else np.zeros(width, np.int64)
        raised = values - self.low
        self.shift = max(int(raised.max(initial=0)).bit_length() - slices, 0)
        cells = raised >> self.shift
        self.bits = [int(c).bit_length() for c in cells.max(axis=0, initial=0)]
        self.valid = self._pack(np.ones(rows, bool))
        self.ones = [[self._pack((cells[:, d] >> j) & 1) for j in range(self.bits[d])] for d in range(width)]
        self.zeros = [[~bitmap for bitmap in own] for own in self.ones]
        self.place = {int(i): n for n, i in enumerate(ids)}

    @staticmethod
    def _pack(flags: np.ndarray) -> np.ndarray:
        packed = np.packbits(flags.astype(bool), bitorder="little")
        return np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view(np.uint64)

    def sum_slices(self, query: np.ndarray) -> list[np.ndarray]:
        """Bitmaps, from the lowest, of the sum of |q| * cell, where cells of negative q are taken from their maximum."""
        columns: list[list[np.ndarray]] = [[]]
        for d, weight in enumerate(query.tolist()):
            bitmaps = self.ones[d] if weight > 0 else self.zeros[d]
            weight = abs(weight)
            for at in range(weight.bit_length()):
                if weight >> at & 1:
                    for j, bitmap in enumerate(bitmaps):
                        while len(columns) <= at + j:
                            columns.append([])
                        columns[at + j].append(bitmap)
        out, c = [], 0
        while c < len(columns):
            column, carries = columns[c], []
            while len(column) > 2:  # three bitmaps become a sum and a carry
                x, y, z = column.pop(), column.pop(), column.pop()
                half = x ^ y
                carry = x & y
                carry |= half & z
                half ^= z
                column.insert(0, half)
                carries.append(carry)
            if len(column) == 2:
                carries.append(column[0] & column[1])
                out.append(column[0] ^ column[1])
            else:
                out.append(column[0] if column else np.zeros_like(self.valid))
            if carries:
                if c + 1 == len(columns):
                    columns.append([])
                columns[c + 1] += carries
            c += 1
        return out

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows but the query's own."""
        rows = self.valid
        own = self.place.get(query_id)
        if own is not None:
            rows = rows.copy()
            rows[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        slices = self.sum_slices(query)
        if int(np.bitwise_count(rows).sum()) > k:
            # The k-th largest sum, bit by bit from the top.
            tied, ahead, threshold = rows, 0, 0
            for c in range(len(slices) - 1, -1, -1):
                upper = tied & slices[c]
                n = int(np.bitwise_count(upper).sum())
                if ahead + n >= k:
                    tied, threshold = upper, threshold | 1 << c
                else:
                    ahead += n
                    tied = tied & ~slices[c]
            # Quantisation hides up to 2**shift - 1 of each component.
            hidden = ((1 << self.shift) - 1) * int(np.abs(query).sum())
            threshold = max(threshold - (hidden >> self.shift), 0)
            above, equal = np.zeros_like(rows), rows
            for c in range(len(slices) - 1, -1, -1):
                if threshold >> c & 1:
                    equal = equal & slices[c]
                else:
                    above |= equal & slices[c]
                    equal = equal & ~slices[c]
            rows = above | equal
        at = np.flatnonzero(np.unpackbits(rows.view(np.uint8), bitorder="little"))
        scores = self.values[at] @ query
        first = np.lexsort((self.ids[at], -scores))[:k]
        return self.ids[at][first], scores[first]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def _search(config: TopKConfig):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(rows) and len(queries):
            width = max(int(np.diff(t.column("v").combine_chunks().offsets.to_numpy()).max()) for t in (rows, queries))
            rows = rows.sort_by("vec_id")
            block = SlicedBlock(rows.column("vec_id").to_numpy(), _matrix(rows.column("v"), width), config.slices)
            wanted = _matrix(queries.column("v"), width)
            for query_id, query in zip(queries.column("vec_id").to_numpy(), wanted, strict=True):
                ids, scores = block.best(int(query_id), query, config.k)
                found.append((np.full(len(ids), query_id), ids, scores))
        none = np.zeros(0, np.int64)
        columns = zip(*found, strict=True) if found else ((none,), (none,), (none,))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, columns), strict=True)))

    return run


def search(vectors: DataFrame, is_query: Column, config: TopKConfig = TopKConfig()) -> DataFrame:
    """query_id, rank, vec_id and score: for each vector that ``is_query`` (of vec_id) selects its k best others."""
    spark = vectors.sparkSession
    rows = stored(quantised(vectors, config), "topk-vectors")
    asked = rows.where(is_query)
    n, m = rows.count(), asked.count()
    row_blocks = max(1, -(-n // config.rows))
    # More, smaller query blocks while there are idle cores; results don't depend on the blocks.
    spare = -(-spark.sparkContext.defaultParallelism // row_blocks)
    query_blocks = max(1, -(-m // config.queries), min(spare, -(-m // 32)))

    def dealt(frame: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        numbers = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return frame.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias(own), numbers, "vec_id", "v")

    pairs = dealt(rows, "row_block", row_blocks, "query_block", query_blocks).groupBy("row_block", "query_block")
    local = pairs.cogroup(dealt(asked, "query_block", query_blocks, "row_block", row_blocks).groupBy("row_block", "query_block")).applyInArrow(
        _search(config), "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= config.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
