"""Aggregates kept up from a change feed equal those computed anew."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from ledgerwatch.operators import maintained, merge

SCHEMA = "id long, k string, day string, v long, n int"
SPEC = maintained.Aggregates(("k", "day"), "day", ("v",), ("v", "n"))


def files(path):
    return {f.relative_to(path).as_posix() for f in Path(path).rglob("*.parquet")}


def load(spark, path, rows, spec=SPEC):
    maintained.computed(spark.createDataFrame(rows, SCHEMA), spec).write.partitionBy("day").parquet(path)


def step(spark, path, before, after, feed_id, spec=SPEC):
    a, b = (spark.createDataFrame(rows, SCHEMA) for rows in (before, after))
    maintained.apply_feed(path, merge.change_feed(a, b, ["id"]), b, spec, feed_id)


def equal(spark, path, rows, spec=SPEC):
    got = maintained.current(spark.read.schema(_schema(spark, spec)).parquet(path), spec)
    want = maintained.current(maintained.computed(spark.createDataFrame(rows, SCHEMA), spec), spec)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def _schema(spark, spec):
    return maintained.computed(spark.createDataFrame([], SCHEMA), spec).schema


def test_random_days_of_changes(spark, tmp_path):
    path, rng = str(tmp_path / "t"), random.Random(5)

    def row(i):
        return (i, rng.choice(["a", "b", None]), rng.choice(["d1", "d2", "d3"]), rng.choice([None, 1, 2, 9]), rng.randint(0, 3))

    rows = {i: row(i) for i in range(60)}
    load(spark, path, list(rows.values()))
    for feed_id in (1, 2):
        after = {i: r for i, r in rows.items() if rng.random() > 0.2}
        after = {i: row(i) if rng.random() < 0.3 else r for i, r in after.items()} | {i: row(i) for i in range(feed_id * 100, feed_id * 100 + 9)}
        step(spark, path, list(rows.values()), list(after.values()), feed_id)
        equal(spark, path, list(after.values()))
        step(spark, path, list(rows.values()), list(after.values()), feed_id)
        equal(spark, path, list(after.values()))
        rows = after


BEFORE = [(1, "a", "d1", 9, 1), (2, "a", "d1", 9, 0), (3, "b", "d1", 5, 0), (4, "b", "d1", 3, 0), (5, "c", "d2", 1, 1), (6, "z", "d3", 1, 1)]


@pytest.mark.parametrize(
    "after",
    [
        [r for r in BEFORE if r[0] != 1],  # one of two equal maxima
        [r for r in BEFORE if r[0] != 3],  # the only maximum
        [(3, "b", "d1", 4, 0) if r[0] == 3 else r for r in BEFORE],  # a maximum that becomes smaller
        [(3, "b", "d1", None, 0) if r[0] == 3 else r for r in BEFORE],  # and one that goes missing
        [r for r in BEFORE if r[0] != 5],  # a partition's last row
        [*BEFORE, (9, None, "d9", None, None)],  # a partition, key and values that are new or missing
    ],
)
def test_maxima_and_empty_groups(spark, tmp_path, after):
    path = str(tmp_path / "t")
    load(spark, path, BEFORE)
    old = files(path)
    step(spark, path, BEFORE, after, 1)
    equal(spark, path, after)
    untouched = {f for f in old if f.startswith("day=d3/")}
    assert untouched and untouched <= files(path)


def test_a_group_that_comes_back(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, BEFORE)
    without = [r for r in BEFORE if r[0] != 5]
    step(spark, path, BEFORE, without, 1)
    step(spark, path, without, [*without, (7, "c", "d2", -3, 0)], 2)
    equal(spark, path, [*without, (7, "c", "d2", -3, 0)])


def test_no_changes_and_what_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, BEFORE)
    old = files(path)
    step(spark, path, BEFORE, BEFORE, 1)
    assert files(path) == old
    with pytest.raises(ValueError):
        maintained.Aggregates(("k",), "day")
    with pytest.raises(TypeError):
        maintained.computed(spark.createDataFrame([], "k string, day string, v double"), maintained.Aggregates(("k", "day"), "day", ("v",)))
