"""Keyed changes against a plain dictionary replay, and SCD2 invariants."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import merge

ROW = "id string, value int, version int"


def batch(rng, keys, version):
    return [(k, rng.randrange(100), version) for k in rng.sample(keys, len(keys) // 2)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_upserts_equal_a_dictionary_replay(spark, seed):
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(20)]
    first = batch(rng, keys, 0)
    state = {r[0]: r for r in first}
    table = spark.createDataFrame(first, ROW)
    for version in (1, 2):
        rows = batch(rng, keys, version)
        table = merge.upsert(table, spark.createDataFrame(rows, ROW), ["id"])
        state |= {r[0]: r for r in rows}
    assert sorted(map(tuple, table.collect())) == sorted(state.values())


@pytest.mark.parametrize("seed", [4, 5])
def test_newest_version_wins(spark, seed):
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(10)]
    stored = [(k, rng.randrange(100), rng.randrange(1, 9)) for k in keys[:7]]
    late = [(k, rng.randrange(100), v) for k in keys[3:] for v in rng.sample(range(10), 2)]
    state = {r[0]: r for r in stored}
    for r in sorted(late, key=lambda r: r[2]):
        if r[0] not in state or r[2] > state[r[0]][2]:
            state[r[0]] = r
    out = merge.newest_wins(spark.createDataFrame(stored, ROW), spark.createDataFrame(late, ROW), ["id"], "version")
    assert sorted(map(tuple, out.collect())) == sorted(state.values())


def test_insert_only_keeps_existing_rows(spark):
    target = spark.createDataFrame([("a", 1, 0)], ROW)
    source = spark.createDataFrame([("a", 2, 1), ("b", 3, 1)], ROW)
    assert sorted(map(tuple, merge.insert_only(target, source, ["id"]).collect())) == [("a", 1, 0), ("b", 3, 1)]


CUSTOMERS = "customer_id string, risk_category string, segment string"
TRACKED = ["risk_category", "segment"]


def dimension(spark, rows):
    return merge.scd2_start(spark.createDataFrame(rows, CUSTOMERS), F.lit(datetime(2024, 1, 1)))


def apply(dim, rows, day):
    source = dim.sparkSession.createDataFrame(rows, CUSTOMERS)
    return merge.scd2_apply(dim, source, ["customer_id"], TRACKED, F.lit(datetime(2024, 1, day)))


def test_scd2_change_null_new_and_unchanged(spark):
    dim = dimension(spark, [("a", "LOW", "X"), ("b", "LOW", None), ("c", "LOW", "X"), ("d", "LOW", "X")])
    out = apply(dim, [("a", "HIGH", "X"), ("b", "LOW", "Y"), ("c", "LOW", "X"), ("e", "MEDIUM", None)], 5)
    versions = {k: n for k, n in out.groupBy("customer_id").count().collect()}
    assert versions == {"a": 2, "b": 2, "c": 1, "d": 1, "e": 1}
    closed = out.filter("NOT is_current").collect()
    assert {r["end_date"] for r in closed} == {datetime(2024, 1, 5)}


def test_scd2_invariants_over_several_runs(spark):
    rng = random.Random(9)
    keys = [f"k{i}" for i in range(12)]
    make = lambda: [(k, rng.choice(["LOW", "HIGH", None]), rng.choice(["X", "Y"])) for k in rng.sample(keys, 8)]
    dim, last = dimension(spark, make()), None
    for day in (5, 9, 12):
        last = make()
        dim = apply(dim, last, day)
    rows = dim.collect()
    for key in {r["customer_id"] for r in rows}:
        spans = sorted(
            (r["effective_date"], r["end_date"] or datetime.max) for r in rows if r["customer_id"] == key
        )
        assert sum(r["is_current"] for r in rows if r["customer_id"] == key) == 1
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert sorted(map(str, apply(dim, last, 20).collect())) == sorted(map(str, rows))


def test_daily_profile_run_closes_the_day_before(spark):
    dim = spark.createDataFrame(
        [("a", "LOW", date(2024, 1, 1), date(9999, 12, 31), True), ("b", None, date(2024, 1, 1), date(9999, 12, 31), True)],
        "customer_id string, risk_category string, effective_date date, expiration_date date, is_current boolean",
    )
    source = spark.createDataFrame([("a", "HIGH"), ("b", "LOW")], "customer_id string, risk_category string")
    out = merge.scd2_risk_category(dim, source, date(2024, 2, 1))
    assert {r["expiration_date"] for r in out.filter("NOT is_current").collect()} == {date(2024, 1, 31)}
    assert {r["expiration_date"] for r in out.filter("is_current").collect()} == {date(9999, 12, 31)}
    assert out.count() == 4


def test_point_in_time(spark):
    out = apply(dimension(spark, [("a", "LOW", "X")]), [("a", "HIGH", "X")], 5)
    on = lambda day: [r["risk_category"] for r in merge.as_of_rows(out, F.lit(datetime(2024, 1, day))).collect()]
    assert (on(3), on(7)) == (["LOW"], ["HIGH"])


def test_change_feed(spark):
    before = spark.createDataFrame([("a", 1, 0), ("b", 1, 0), ("c", None, 0)], ROW)
    after = spark.createDataFrame([("a", 1, 0), ("b", 2, 0), ("d", 1, 0)], ROW)
    feed = sorted((r["_change_type"], r["id"]) for r in merge.change_feed(before, after, ["id"]).collect())
    assert feed == [("delete", "c"), ("insert", "d"), ("update_postimage", "b"), ("update_preimage", "b")]


def test_repeated_source_keys_count_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (3, "z")], "k int, v string")
    for merged in (merge.upsert(target, source, ["k"]), merge.conditional_merge(target, source, ["k"])):
        assert sorted(map(tuple, merged.collect())) == [(1, "y"), (2, "b"), (3, "z")]
    dimension = merge.scd2_start(target, F.lit(datetime(2024, 1, 1)))
    changed = merge.scd2_apply(dimension, source, ["k"], ["v"], F.lit(datetime(2024, 2, 1)))
    current = sorted((r.k, r.v) for r in merge.current_rows(changed).collect())
    assert current == [(1, "y"), (2, "b"), (3, "z")]
    assert changed.count() == 4
