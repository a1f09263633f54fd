"""Compare two large tables by digests: only the parts that differ are looked at row by row.

A part's digest is its number of rows and two sums of 64-bit row hashes. Sums
do not depend on order, keep count of repeated rows, and add up from buckets to
days, so one stored table of bucket digests answers for every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import run_dir

SUMS = ("n_rows", "digest_a", "digest_b")


def _hash(columns: list[str], salt: int) -> Column:
    """Hash of a row. A hash skips nulls, so which values are null is hashed with it."""
    return F.xxhash64(F.lit(salt), *columns, *[F.col(c).isNull() for c in columns]).cast("decimal(20,0)")


def _signed(df: DataFrame, key: list[str], part: str, buckets: int, sign: int) -> DataFrame:
    columns = sorted(df.columns)
    return df.select(
        *[F.col(k).alias(f"key_{k}") for k in key],
        F.col(part).alias("part"),
        F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket"),
        F.lit(sign).cast("bigint").alias("n_rows"),
        (_hash(columns, 1) * sign).alias("digest_a"),
        (_hash(columns, 2) * sign).alias("digest_b"),
    )


def digests(df: DataFrame, key: list[str], part: str, buckets: int = 1024) -> DataFrame:
    """part, bucket, n_rows, digest_a, digest_b; sums are taken before the shuffle."""
    rows = _signed(df, key, part, buckets, 1)
    return rows.groupBy("part", "bucket").agg(*[F.sum(s).alias(s) for s in SUMS])


def coarser(fine: DataFrame) -> DataFrame:
    """Digests of whole parts from those of their buckets."""
    return fine.groupBy("part").agg(*[F.sum(s).alias(s) for s in SUMS])


def differing(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """The groups whose digests are not the same, or that only one side has."""
    minus = right.select(*by, *[(-F.col(s)).alias(s) for s in SUMS])
    both = left.select(*by, *SUMS).unionByName(minus)
    unequal = " OR ".join(f"{s} <> 0" for s in SUMS)
    return both.groupBy(*by).agg(*[F.sum(s).alias(s) for s in SUMS]).filter(unequal).select(*by)


def suspects(
    left: DataFrame, right: DataFrame, left_digests: DataFrame, right_digests: DataFrame, key: list[str], part: str, buckets: int = 1024
) -> DataFrame:
    """The rows of both tables, as signed hashes, that lie in differing buckets of differing parts.

    Parts are compared first, so buckets are compared only in parts that differ.
    The list of buckets is written to the shared folder: both tables are
    filtered by the same list, and its size is known when the join is planned.
    """
    _same_columns(left, right)
    parts = differing(coarser(left_digests), coarser(right_digests), ["part"])
    within = [_semi(d, parts, ["part"]) for d in (left_digests, right_digests)]
    path = run_dir(left.sparkSession, "differing-buckets")
    differing(*within, ["part", "bucket"]).write.parquet(path)
    found = left.sparkSession.read.parquet(path)
    sides = [_semi(_signed(df, key, part, buckets, s), found, ["part", "bucket"]) for df, s in ((left, 1), (right, -1))]
    return sides[0].unionByName(sides[1])


def differing_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """From ``suspects``: key, status, rows_left, rows_right for each key whose rows differ.

    ``missing``: only the left table has it; ``unexpected``: only the right one;
    ``changed``: both, with other values, another part or another number of copies.
    Null is a key like any other.
    """
    sums = rows.groupBy(*[F.col(f"key_{k}").alias(k) for k in key]).agg(
        F.count_if(F.col("n_rows") > 0).alias("rows_left"),
        F.count_if(F.col("n_rows") < 0).alias("rows_right"),
        F.sum("digest_a").alias("digest_a"),
        F.sum("digest_b").alias("digest_b"),
    )
    unequal = "rows_left <> rows_right OR digest_a <> 0 OR digest_b <> 0"
    status = F.when(F.col("rows_right") == 0, "missing").when(F.col("rows_left") == 0, "unexpected").otherwise("changed")
    return sums.filter(unequal).select(*key, status.alias("status"), "rows_left", "rows_right")


def reconcile_tables(left: DataFrame, right: DataFrame, key: list[str], part: str, buckets: int = 1024) -> DataFrame:
    """Every key whose rows differ between two tables of the same columns."""
    a, b = (digests(df, key, part, buckets) for df in (left, right))
    return differing_keys(suspects(left, right, a, b, key, part, buckets), key)


def _semi(df: DataFrame, some: DataFrame, on: list[str]) -> DataFrame:
    listed = some.select(*[F.col(c).alias(f"__some_{c}") for c in on])
    return df.join(listed, [F.col(c).eqNullSafe(F.col(f"__some_{c}")) for c in on], "left_semi")


def _same_columns(left: DataFrame, right: DataFrame) -> None:
    a, b = ({f.name: f.dataType for f in df.schema.fields} for df in (left, right))
    if a != b:
        raise ValueError(f"columns differ: {sorted(c for c in a.keys() | b.keys() if a.get(c) != b.get(c))}")
