"""Curve layout, distinct counts that merge, and comparison by digests."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.operators import curve, digests, distinct


def grid(spark, side=64):
    return spark.range(side * side).select((F.col("id") % side).alias("a"), F.floor(F.col("id") / side).alias("b"))


def test_curve_position_interleaves_ranks(spark):
    placed = curve.with_curve_position(grid(spark, 4), ["a", "b"], bits=2)
    got = {(r["a"], r["b"]): r[curve.POSITION] for r in placed.collect()}

    def spread(n):
        return (n & 1) | ((n & 2) << 1)

    # Equal shares: a bound is the last value below a quarter, so ranks run 1, 2, 3, 3.
    rank = {0: 1, 1: 2, 2: 3, 3: 3}
    assert got == {(a, b): spread(rank[a]) * 2 + spread(rank[b]) for a in range(4) for b in range(4)}


def test_each_column_alone_skips_files(spark, tmp_path):
    curve.curve_cluster(grid(spark), ["a", "b"], 16, bits=4).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    spans = [curve.Span("a", "a", 10, 12), curve.Span("b", "b", 10, 12), curve.Span("none", "a", 900, 901)]
    got = {r["span"]: r for r in curve.files_touched(table, spans).collect()}
    assert got["a"]["rows_found"] == got["b"]["rows_found"] == 3 * 64
    assert got["a"]["files_touched"] <= 8 and got["b"]["files_touched"] <= 8
    assert got["none"]["files_touched"] == got["none"]["rows_found"] == 0
    assert sorted(table.collect()) == sorted(grid(spark).collect())


def test_a_frequent_value_is_spread_over_files(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("k"), "id")
    curve.curve_cluster(df, ["k"], 8, bits=4).write.parquet(str(tmp_path / "t"))
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1200


def test_curve_takes_nulls_strings_dates_and_empty_tables(spark):
    schema = "s string, d date, f boolean, m map<string,int>"
    rows = [("b", dt.date(2024, 1, 2), True, {"x": 1}), (None, None, None, None), ("", dt.date(1960, 1, 1), False, {}), ("é", None, True, None)]
    df = spark.createDataFrame(rows * 2, schema)
    out = curve.curve_cluster(df, ["s", "d", "f"], 2, bits=3)
    assert out.columns == df.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert curve.curve_cluster(spark.createDataFrame([], schema), ["s", "d"], 2).count() == 0
    with pytest.raises(TypeError):
        curve.with_curve_position(df, ["m"])
    with pytest.raises(ValueError):
        curve.with_curve_position(df, ["s", "d"], bits=32)


def test_strings_rank_in_byte_order(spark):
    words = ["", "a", "ab", "b", "bb", "z", "é", "日本"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = curve.with_curve_position(df, ["s"], bits=4).orderBy(curve.POSITION, "s").collect()
    assert [r["s"] for r in got] == sorted(words, key=lambda w: w.encode())


def keyed(spark, names):
    return spark.createDataFrame([(n,) for n in names], "k string")


def test_numbers_are_kept_and_never_shared_between_loads(spark):
    first = distinct.number_keys(keyed(spark, ["a", "b", None, "a", "c"]), "k", buckets=4)
    second = distinct.number_keys(keyed(spark, ["c", "d", "e", "a"]), "k", first, buckets=4)
    a, b = ({r["k"]: r["key_number"] for r in t.collect()} for t in (first, second))
    assert a.keys() == {"a", "b", "c"} and b.keys() == {"a", "b", "c", "d", "e"}
    assert a.items() <= b.items() and len(set(b.values())) == 5


def test_numbers_are_dense(spark):
    names = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    top = distinct.number_keys(names, "k", buckets=16).agg(F.max("key_number")).first()[0]
    assert 20_000 <= top + 1 < 24_000


def test_bitmaps_merge_to_the_exact_distinct_count(spark):
    df = spark.range(60_000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 10).cast("int")).alias("day"),
        F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") * 3 % 100_003).alias("n"),
    )
    parts = distinct.members(df, "n", ["day"])
    exact = {r["day"]: r["c"] for r in df.groupBy("day").agg(F.count_distinct("n").alias("c")).collect()}
    assert {r["day"]: r["n_distinct"] for r in distinct.count_members(parts, ["day"]).collect()} == exact
    assert distinct.count_members(parts.unionByName(parts), []).first()["n_distinct"] == df.select("n").distinct().count() - 1
    rolling = {r["day"]: r["n_distinct"] for r in distinct.rolling_distinct(parts, "day", 3).collect()}
    day = dt.date(2024, 1, 6)
    frame = df.filter(F.col("day").between(dt.date(2024, 1, 4), day))
    assert rolling.keys() == exact.keys() and rolling[day] == frame.agg(F.count_distinct("n")).first()[0]


def test_no_members(spark):
    parts = distinct.members(spark.createDataFrame([], "n long, day date"), "n", ["day"])
    assert distinct.count_members(parts, ["day"]).count() == distinct.rolling_distinct(parts, "day", 7).count() == 0


SCHEMA = "id long, day date, a string, b string"
DAY = dt.date(2024, 1, 1)


def compared(spark, left, right, buckets=8):
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (left, right)]
    out = digests.reconcile_tables(*frames, ["id"], "day", buckets)
    return {r["id"]: (r["status"], r["rows_left"], r["rows_right"]) for r in out.collect()}


def test_every_kind_of_difference(spark):
    left = [(i, DAY, "x", "y") for i in range(20)] + [(None, DAY, "x", None), (30, None, "x", "y"), (31, DAY, None, "q")]
    assert compared(spark, left, list(reversed(left))) == {}
    right = [r for r in left if r[0] != 3] + [(4, DAY, "x", "y"), (40, DAY, "x", "y")]
    right = [(31, DAY, "q", None) if r[0] == 31 else r for r in right]
    right = [(r[0], DAY, *r[2:]) if r[0] == 30 else r for r in right]
    right = [(None, DAY, "x", "") if r[0] is None else r for r in right]
    assert compared(spark, left, right) == {
        3: ("missing", 1, 0), 4: ("changed", 1, 2), 40: ("unexpected", 0, 1), 31: ("changed", 1, 1), 30: ("changed", 1, 1), None: ("changed", 1, 1),
    }


def test_exchanged_values_of_two_rows_do_not_cancel(spark):
    left, right = [(1, DAY, "x", "p"), (2, DAY, "y", "p")], [(1, DAY, "y", "p"), (2, DAY, "x", "p")]
    assert compared(spark, left, right, buckets=1) == {1: ("changed", 1, 1), 2: ("changed", 1, 1)}
    assert compared(spark, [], []) == {} and compared(spark, left[:1], []) == {1: ("missing", 1, 0)}


def test_only_differing_buckets_are_read_row_by_row(spark):
    left = spark.range(10_000).select("id", F.date_add(F.lit(DAY), (F.col("id") % 5).cast("int")).alias("day"), F.col("id").alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 77, -1).otherwise(F.col("v")))
    a, b = (digests.digests(df, ["id"], "day", 100) for df in (left, right))
    rows = digests.suspects(left, right, a, b, ["id"], "day", 100)
    assert 2 <= rows.count() < 200
    assert [r["id"] for r in digests.differing_keys(rows, ["id"]).collect()] == [77]


def test_tables_of_other_columns_are_refused(spark):
    left = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="'a'"):
        digests.reconcile_tables(left, left.withColumn("a", F.lit(1).cast(T.LongType())), ["id"], "day")
