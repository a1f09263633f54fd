"""Column profiles, drift, and messages of several generations."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.operators import columns, ingest


def test_merged_days_describe_the_whole(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 7).alias("day"),
        F.when(F.col("id") % 10 != 0, F.col("id") % 5000).alias("v"),
        F.concat(F.lit("k"), F.col("id") % 300).alias("s"),
        F.lit(None).cast("double").alias("nothing"),
        F.array("id").alias("a"),
        F.create_map(F.lit("x"), "id").alias("m"),
    )
    days = columns.profile(df, ["day"])
    assert days.count() == 7 * 5
    got = {r["column_name"]: r for r in columns.described(columns.merge_profiles(days, []), (0.5,)).collect()}
    assert {c: (r["n_rows"], r["nulls"]) for c, r in got.items()} == {
        "v": (20_000, 2000), "s": (20_000, 0), "nothing": (20_000, 20_000), "a": (20_000, 0), "m": (20_000, 0)
    }
    assert (got["v"]["low"], got["v"]["high"]) == (1, 4999)
    assert abs(got["v"]["n_distinct"] - 4500) < 4500 * 0.08 and abs(got["s"]["n_distinct"] - 300) < 300 * 0.08
    assert abs(got["a"]["n_distinct"] - 20_000) < 20_000 * 0.08 and got["nothing"]["n_distinct"] == 0
    assert abs(got["v"]["quantiles"][0] - 2500) < 100
    assert got["nothing"]["quantiles"] is None and got["m"]["low"] is None


def test_empty_table_has_no_profile(spark):
    df = spark.createDataFrame([], "day int, v int")
    assert columns.profile(df, ["day"]).count() == 0 and columns.profile(df.drop("day"), []).count() == 0


def test_distance_is_near_the_exact_one(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, 6000), rng.normal(0.4, 1.3, 9000)
    points = np.sort(np.concatenate([a, b]))
    exact = np.abs(
        np.searchsorted(np.sort(a), points, "right") / len(a) - np.searchsorted(np.sort(b), points, "right") / len(b)
    ).max()
    frames = [spark.createDataFrame([(float(v),) for v in side], "v double") for side in (a, b)]
    row = columns.drift(*[columns.profile(f, []) for f in frames], limit=0.1).first()
    assert abs(row["distance"] - exact) < 0.03 and row["drifted"]


def test_same_columns_do_not_drift_and_missing_ones_do(spark):
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("b"), F.lit(None).cast("int").alias("n"))
    got = {r["column_name"]: r for r in columns.drift(columns.profile(df, []), columns.profile(df.drop("b"), [])).collect()}
    assert got["id"]["distance"] < 0.03 and not got["id"]["drifted"]
    assert got["n"]["distance"] is None and not got["n"]["drifted"]
    assert got["b"]["drifted"]


SCHEMA = T.StructType().add("id", "string").add("amount", "decimal(18,2)").add("at", "timestamp")


def test_no_field_of_a_message_is_lost(spark):
    values = [
        '{"id":"a","amount":"12.5","at":"2024-01-01 10:00:00"}',
        '{"id":7,"amount":"much","x":{"y":[1,null]},"n":null}',
        '{"amount":1e400}',
        "{}",
        "[1]",
        "{broken",
        "",
        None,
    ]
    raw = spark.createDataFrame([(v, 1) for v in values], "value string, offset int")
    out = ingest.parse_evolving(raw, SCHEMA).withColumn("other_fields", F.to_json("other_fields"))
    assert out.columns == ["id", "amount", "at", "other_fields", "unparsed"]
    got = [(r["id"], None if r["amount"] is None else str(r["amount"]), r["at"] is None, r["other_fields"], r["unparsed"]) for r in out.collect()]
    assert got[0] == ("a", "12.50", False, None, None)
    assert got[1] == ("7", None, True, '{"amount":"much","x":{"y":[1,null]}}', None)
    assert got[2][1] is None and (got[2][3] or got[2][4])
    assert got[3] == (None, None, True, None, None)
    assert [g[4] for g in got[4:]] == ["[1]", "{broken", "", None]


def test_a_schema_with_the_name_of_the_rest_is_refused(spark):
    with pytest.raises(ValueError):
        ingest.parse_evolving(spark.createDataFrame([], "value string"), T.StructType().add("other_fields", "string"))
