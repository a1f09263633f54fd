"""As-of look-up against a plain search."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from ledgerwatch.operators.asof import last_version

START = datetime(2024, 1, 1)
ROWS, VERSIONS = "id long, k string, at timestamp", "k string, since timestamp, a int, b string"


def looked_up(spark, rows, versions, **more):
    frames = spark.createDataFrame(rows, ROWS), spark.createDataFrame(versions, VERSIONS)
    out = last_version(*frames, "k", "at", "since", ["a", "b"], **more)
    assert out.columns == ["id", "k", "at", "a", "b"]
    return sorted(map(tuple, out.collect()), key=str)


def plain(rows, versions):
    out = []
    for i, k, at in rows:
        own = [(s, a, b) for key, s, a, b in versions if None not in (k, at, key, s) and key == k and s <= at]
        best = max(own, key=lambda v: (v[0], v[1], v[2])) if own else (None, None, None)
        out.append((i, k, at, *best[1:]))
    return sorted(out, key=str)


@pytest.mark.parametrize("hours", [1, 24, 24 * 365])
def test_random_versions_over_many_slices(spark, hours):
    rng = random.Random(hours)

    def moment():
        return None if rng.random() < 0.03 else START + timedelta(hours=rng.randint(-60, 240))

    keys = ["hot"] * 6 + ["a", "b", None, "unknown"]
    rows = [(i, rng.choice(keys), moment()) for i in range(500)]
    versions = [(rng.choice(["hot", "a", "b", None]), moment(), rng.randint(0, 9), rng.choice("xyz")) for _ in range(60)]
    assert looked_up(spark, rows * 2, versions, slice_hours=hours) == plain(rows * 2, versions)


def test_a_key_with_a_thousand_versions(spark):
    versions = [("k", START + timedelta(minutes=17 * i), i, "v") for i in range(1000)]
    rows = [(i, "k", START + timedelta(minutes=13 * i)) for i in range(-5, 1400)]
    assert looked_up(spark, rows, versions) == plain(rows, versions)


def test_nulls_in_the_payload_are_values(spark):
    versions = [("k", START, 1, "x"), ("k", START + timedelta(hours=1), None, None)]
    rows = [(1, "k", START), (2, "k", START + timedelta(days=9))]
    assert looked_up(spark, rows, versions) == [(1, "k", START, 1, "x"), (2, "k", rows[1][2], None, None)]


def test_empty_tables_and_clashing_columns(spark):
    assert looked_up(spark, [], [("k", START, 1, "x")]) == []
    assert looked_up(spark, [(1, "k", START)], []) == [(1, "k", START, None, None)]
    with pytest.raises(ValueError, match="id"):
        last_version(spark.createDataFrame([], ROWS), spark.createDataFrame([], "k string, since timestamp, id long"), "k", "at", "since", ["id"])
