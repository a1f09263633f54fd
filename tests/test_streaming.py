"""Streams against batch results, over several ordered micro-batches."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerwatch.config import RuleConfigA
from ledgerwatch.operators import ingest, rules, velocity
from ledgerwatch.plans import alerting
from ledgerwatch.plans.catalog import streams
from ledgerwatch.plans.catalog.inputs import Inputs
from ledgerwatch.session import shared_dir
from ledgerwatch.sources import messages
from ledgerwatch.streaming import late, medallion, sinks, split, stateful, windows
from ledgerwatch.streaming.progress import ProgressLog

CFG = RuleConfigA()
EDGES = [datetime(2024, 1, d) for d in (1, 9, 10, 11, 31)]


@pytest.fixture(scope="module")
def x(spark, small):
    return Inputs(spark, small)


@pytest.fixture(scope="module")
def typed_files(x, tmp_path_factory):
    """Typed transactions as files in event-time order, one per period."""
    path = str(tmp_path_factory.mktemp("typed"))
    typed = alerting.typed_amounts(x.bronze, x.dimensions)
    for low, high in zip(EDGES, EDGES[1:], strict=False):
        ts = F.col("transaction_timestamp")
        typed.filter((ts >= F.lit(low)) & (ts < F.lit(high))).coalesce(1).write.mode("append").parquet(path)
    return path, typed


def stream_of(spark, typed_files):
    path, typed = typed_files
    return messages.file_stream(spark, path, typed.schema, max_files_per_trigger=1)


def table_of(spark, stream, tmp_path):
    sinks.finish(sinks.append_stream(stream, str(tmp_path / "table"), str(tmp_path / "checkpoint")))
    return spark.read.schema(stream.schema).parquet(str(tmp_path / "table"))


def test_state_carries_over_batches(spark, typed_files, tmp_path):
    spark.conf.set(stateful.STATE_STORE, stateful.ROCKSDB)
    stream = stateful.stateful_velocity(stream_of(spark, typed_files))
    got = table_of(spark, stream, tmp_path)
    batch = velocity.trailing_velocity(typed_files[1], CFG)
    columns = ["transaction_id", "rolling_24h_amount", "rolling_24h_count"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))


def test_stored_state_carries_over_batches(spark, typed_files, tmp_path):
    output = str(tmp_path / "out")
    handler = medallion.velocity_handler(spark, str(tmp_path / "state"), output, CFG)
    sinks.finish(sinks.each_batch(stream_of(spark, typed_files), handler, str(tmp_path / "checkpoint")))
    got = spark.read.parquet(output)
    assert got.select("batch_id").distinct().count() == len(EDGES) - 1
    batch = velocity.trailing_velocity(typed_files[1], CFG)
    columns = ["transaction_id", "rolling_24h_amount", "rolling_24h_count"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))


@pytest.mark.parametrize("spread", [0, 4])
def test_repeated_messages_across_batches_are_dropped(spark, tmp_path, spread):
    schema = "transaction_id string, transaction_timestamp timestamp"
    start = datetime(2024, 1, 1, 12)
    for rows in ([("a", start), ("b", start)], [("a", start), ("c", start + timedelta(minutes=5))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = messages.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
    out = table_of(spark, windows.unique_transactions(stream, spread=spread), tmp_path)
    assert sorted(r["transaction_id"] for r in out.collect()) == ["a", "b", "c"]


@pytest.fixture(scope="module")
def medallion_run(spark, x, tmp_path_factory):
    """Messages in four ordered files through all layers; one file is delivered twice."""
    base = tmp_path_factory.mktemp("medallion")
    source = x.messages
    for low, high in zip(EDGES, EDGES[1:], strict=False):
        part = source.filter((F.col("timestamp") >= F.lit(low)) & (F.col("timestamp") < F.lit(high)))
        part.coalesce(1).write.mode("append").parquet(str(base / "in"))
    stream = messages.file_stream(spark, str(base / "in"), source.schema, max_files_per_trigger=1)
    parsed = ingest.parse_messages(stream, ingested_at=F.col("kafka_timestamp"))
    paths = medallion.MedallionPaths.under(str(base / "out"))
    handler = medallion.batch_handler(x.dimensions, CFG, paths)
    sinks.finish(sinks.each_batch(parsed, handler, str(base / "checkpoint")))
    return paths, handler, parsed


def alert_rows(spark, paths):
    return sorted(map(tuple, spark.read.parquet(paths.alerts).select("alert_id", "risk_score").collect()))


def test_stream_alerts_equal_batch_alerts(spark, x, medallion_run):
    paths = medallion_run[0]
    readable = ingest.contract_violations(x.bronze)
    cut_off = F.substring("transaction_id", 4, 10).cast("bigint") % 103 == 0
    accepted = ingest.split_quarantine(readable.filter(~cut_off))[0]
    batch = alerting.build_alerts(accepted, x.dimensions, CFG, F.col("ingestion_timestamp"))
    want = sorted(map(tuple, rules.alert_columns(batch).select("alert_id", "risk_score").collect()))
    assert alert_rows(spark, paths) == want


def test_bronze_holds_every_message(spark, x, medallion_run):
    bronze = spark.read.parquet(medallion_run[0].bronze)
    assert bronze.count() == x.messages.count()
    assert bronze.filter("CAST(quarantined AS BOOLEAN) <> (size(violations) > 0)").count() == 0
    assert bronze.filter("CAST(quarantined AS BOOLEAN)").count() > 0


def test_repeating_a_batch_changes_nothing(spark, x, medallion_run):
    paths, handler, parsed = medallion_run
    before = alert_rows(spark, paths)
    replay = spark.read.parquet(paths.bronze).filter("batch_id = 1").select(parsed.columns)
    handler(spark.createDataFrame(replay.collect(), replay.schema), 1)
    assert alert_rows(spark, paths) == before


def test_progress_log(spark, typed_files, tmp_path):
    log = ProgressLog()
    spark.streams.addListener(log)
    stream = stream_of(spark, typed_files).select("transaction_id")
    sinks.finish(sinks.append_stream(stream, str(tmp_path / "t"), str(tmp_path / "c"), name="progress_test"))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(log)
    seen = log.to_frame(spark).filter("query_name = 'progress_test'")
    assert seen.agg(F.sum("input_rows")).first()[0] == typed_files[1].count()


def test_topic_options():
    options = messages.topic_options("broker:9092", "transactions")
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "10000"


def test_progress_is_appended_and_kept(spark, tmp_path):
    log = ProgressLog()
    for batch in range(2500):
        log.reports.append(("q", batch, 1, 1.0, 5))
        if batch % 900 == 0:
            log.append_to(spark, str(tmp_path / "progress"))
    log.append_to(spark, str(tmp_path / "progress"))
    log.append_to(spark, str(tmp_path / "progress"))
    assert spark.read.parquet(str(tmp_path / "progress")).count() == 2500 and not log.reports


def test_chained_windows_hold_hours_not_copies(spark, typed_files, tmp_path):
    stream = windows.sliding_totals(stream_of(spark, typed_files)).select("customer_id", "window", "rolling_24h_amount", "rolling_24h_count")
    query = sinks.append_stream(stream, str(tmp_path / "table"), str(tmp_path / "checkpoint"))
    sinks.finish(query)
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "table"))
    typed = typed_files[1].filter("transaction_timestamp < '2024-01-31'")
    plain = typed.groupBy(F.window("transaction_timestamp", "24 hours", "1 hour"), "customer_id").agg(
        F.sum("amount_eur").alias("rolling_24h_amount"), F.count("*").alias("rolling_24h_count")
    )
    newest = typed.agg(F.max("transaction_timestamp")).first()[0]
    closed = plain.filter(F.col("window.end") <= F.lit(newest - timedelta(hours=2)))
    columns = ["customer_id", "window", "rolling_24h_amount", "rolling_24h_count"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, closed.select(columns).collect()))
    # What arrives is kept as customer-hours; the second window holds only what it cannot close yet.
    hours = typed.select("customer_id", F.date_trunc("hour", "transaction_timestamp")).distinct().count()
    first = [p.stateOperators[-1] for p in query.recentProgress if p.numInputRows]
    assert len(query.recentProgress[0].stateOperators) == 2
    assert all(s.operatorName == "stateStoreSave" for s in first) and max(s.numRowsTotal for s in first) <= hours
    assert sum(s.numRowsUpdated for s in first) <= hours < plain.count() / 4


def test_left_window_join_over_batches(spark, typed_files, tmp_path):
    """Late rows are left out on both sides; rows without a customer come with nulls once their window is closed."""
    lonely = F.crc32(F.col("transaction_id").cast("binary")) % 10 == 0
    source = stream_of(spark, typed_files).withColumn("customer_id", F.when(~lonely, F.col("customer_id")))
    joined = windows.with_window_totals(source).select("transaction_id", "customer_id", "window", "rolling_24h_count")
    got = table_of(spark, joined, tmp_path)
    typed = typed_files[1].filter("transaction_timestamp < '2024-01-31'").withColumn("customer_id", F.when(~lonely, F.col("customer_id")))
    placed = typed.select("transaction_id", "customer_id", F.window("transaction_timestamp", "24 hours", "1 hour").alias("window"))
    newest = typed.agg(F.max("transaction_timestamp")).first()[0]
    counts = placed.groupBy("customer_id", "window").agg(F.count("*").alias("rolling_24h_count"))
    expected = placed.filter(F.col("window.end") <= F.lit(newest - timedelta(hours=2))).join(counts, ["customer_id", "window"], "left")
    columns = ["transaction_id", "window", "rolling_24h_count"]
    ours, theirs = (sorted(map(str, f.select(columns).collect())) for f in (got, expected))
    assert ours == theirs and any("rolling_24h_count=None" in r for r in ours)


def test_late_rows_reach_the_totals(spark, typed_files, tmp_path):
    path = str(tmp_path / "in")
    typed = typed_files[1].withColumn("customer_id", F.when(F.col("customer_id") != "C00000003", F.col("customer_id")))
    held = F.crc32(F.col("transaction_id").cast("binary")) % 5 == 0
    ts = F.col("transaction_timestamp")
    middle = F.lit(datetime(2024, 1, 12))
    for part in (typed.filter(~held & (ts < middle)), typed.filter(~held & (ts >= middle)), typed.filter(held)):
        part.coalesce(1).write.mode("append").parquet(path)
    paths = late.LatePaths.under(str(tmp_path / "out"))
    handler = late.totals_handler(spark, paths)
    seen = []

    def twice(batch, batch_id):
        """Every batch is repeated, as after a failure."""
        handler(batch, batch_id)
        handler(batch, batch_id)
        seen.append(batch_id)

    sinks.finish(sinks.each_batch(messages.file_stream(spark, path, typed.schema, max_files_per_trigger=1), twice, str(tmp_path / "checkpoint")))
    assert seen == [0, 1, 2]
    got = {(r.customer_id, r.hour): (r.amount, r.transactions, r.late) for r in late.totals(spark, paths).collect()}
    newest = typed.filter(~held).agg(F.max(ts)).first()[0]
    behind = held & (ts < F.lit(newest - timedelta(hours=2)))
    plain = typed.groupBy(F.coalesce("customer_id", F.lit(late.UNKNOWN)).alias("c"), F.date_trunc("hour", ts).alias("h")).agg(
        F.sum("amount_eur").alias("a"), F.count("*").alias("n"), F.count_if(behind).alias("l")
    )
    assert got == {(r.c, r.h): (r.a, r.n, r.l) for r in plain.collect()} and (late.UNKNOWN in {c for c, _ in got})
    lines = {r.batch_id: r for r in late.progress(spark, paths).collect()}
    assert [lines[b].late_rows for b in range(3)] == [0, 0, typed.filter(behind).count()] and lines[2].late_rows > 0
    assert sum(lines[b]["rows"] for b in range(3)) == typed.count() and lines[0].watermark is None


def closed_velocity(typed):
    """What ``split_velocity`` has to return at the end: rows of hours that the watermark has passed."""
    mark = typed.agg(F.max("transaction_timestamp")).first()[0] - timedelta(hours=2)
    closed = F.date_trunc("hour", "transaction_timestamp") + F.expr("INTERVAL 1 HOUR") <= F.lit(mark)
    return velocity.trailing_velocity(typed, CFG).filter(closed)


def test_split_state_equals_batch_over_batches(spark, typed_files, tmp_path):
    spark.conf.set(stateful.STATE_STORE, stateful.ROCKSDB)
    got = table_of(spark, split.split_velocity(stream_of(spark, typed_files)), tmp_path)
    columns = ["customer_id", "transaction_id", "rolling_24h_amount", "rolling_24h_count"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, closed_velocity(typed_files[1]).select(columns).collect())
    )


def test_split_state_with_one_customer_in_most_rows(spark, tmp_path):
    """Ties, rows exactly a day apart, late but not too late rows, rows without customer or amount; state is given back."""
    spark.conf.set(stateful.STATE_STORE, stateful.ROCKSDB)
    start = datetime(2024, 1, 1)
    minutes = [7 * i % 3600 for i in range(1500)] + [0, 1440, 1440, 2880]
    rows = [(f"t{i}", None if i % 50 == 1 else "hot" if i % 3 else f"c{i % 4}", m, None if i % 40 == 5 else i) for i, m in enumerate(minutes)]
    rows += [("last", "end", 6000, 1)]
    schema = "transaction_id string, customer_id string, minute int, cents long"
    df = spark.createDataFrame(rows, schema).select(
        "transaction_id",
        "customer_id",
        F.timestamp_add("MINUTE", F.col("minute"), F.lit(start)).alias("transaction_timestamp"),
        (F.col("cents").cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("amount_eur"),
    )
    late_part = F.col("transaction_timestamp") < F.lit(start + timedelta(hours=30))
    swapped = F.minute("transaction_timestamp") >= 30  # comes in an earlier file than the start of its own hour
    for part in (late_part & swapped, late_part & ~swapped, ~late_part):
        # One watermark step at most between halves: both lie within the first files.
        df.filter(part & (F.col("transaction_id") != "last")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    df.filter("transaction_id = 'last'").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = messages.file_stream(spark, str(tmp_path / "in"), df.schema, max_files_per_trigger=2)
    query = sinks.append_stream(split.split_velocity(stream), str(tmp_path / "table"), str(tmp_path / "checkpoint"))
    sinks.finish(query)
    got = spark.read.parquet(str(tmp_path / "table")).collect()

    want = []
    known = [(t, c, m, a or 0) for t, c, m, a in rows]
    for t, c, m, _ in known[:-1]:
        frame = [a for _, other, at, a in known if other == c and m - 1440 <= at <= m]
        want.append((t, sum(frame), len(frame)))
    assert sorted((r["transaction_id"], int(r["rolling_24h_amount"] * 100), r["rolling_24h_count"]) for r in got) == sorted(want)
    left = {s["operatorName"]: s["numRowsTotal"] for s in query.lastProgress["stateOperators"]}
    assert left["transformWithStateInPandasExec"] < 20 and left["symmetricHashJoin"] < 60


def test_window_join_keeps_a_transaction_once(spark, tmp_path):
    """The state of the join holds a row per waiting transaction, not one per window; inner has the same rows with customers."""
    start = datetime(2024, 1, 1)
    rows = [(f"t{i}", f"c{i % 40}" if i % 10 else None, start + timedelta(minutes=11 * i), 1) for i in range(400)]
    rows.append(("last", "end", start + timedelta(days=9), 1))
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, transaction_timestamp timestamp, amount int").select(
        "transaction_id", "customer_id", "transaction_timestamp", F.col("amount").cast("decimal(18,2)").alias("amount_eur")
    )
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    got = {}
    for how in ("left", "inner"):
        stream = messages.file_stream(spark, str(tmp_path / "in"), df.schema)
        joined = windows.with_window_totals(stream, how=how).select("transaction_id", "transaction_timestamp", "rolling_24h_count")
        query = sinks.append_stream(joined, str(tmp_path / how), str(tmp_path / f"checkpoint-{how}"))
        sinks.finish(query)
        got[how] = sorted(map(tuple, spark.read.schema(joined.schema).parquet(str(tmp_path / how)).collect()), key=str)
        held = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators if s.operatorName == "symmetricHashJoin"]
        assert 0 < max(held) <= len(rows) and held[-1] <= 1
    assert len(got["left"]) == 24 * 400 and got["inner"] == [r for r in got["left"] if int(r[0][1:]) % 10]
    assert [r for r in got["left"] if r[2] is None] == [r for r in got["left"] if not int(r[0][1:]) % 10]


def test_split_state_follows_groups_not_customers(spark, tmp_path):
    """Many customers of one hour are a call for each group: a list entry of either role and a timer with its index."""
    before = spark.conf.get(stateful.STATE_STORE)
    spark.conf.set(stateful.STATE_STORE, stateful.ROCKSDB)
    start = datetime(2024, 1, 1, 6)
    rows = [(f"t{i}", f"c{i // 2}", start + timedelta(hours=24 * (i % 2), seconds=i), i) for i in range(600)]
    rows.append(("last", "end", start + timedelta(days=4), 1))
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, transaction_timestamp timestamp, cents int").select(
        "transaction_id", "customer_id", "transaction_timestamp", (F.col("cents") / 100).cast("decimal(18,2)").alias("amount_eur")
    )
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = messages.file_stream(spark, str(tmp_path / "in"), df.schema)
    query = sinks.append_stream(split.split_velocity(stream, groups=4), str(tmp_path / "table"), str(tmp_path / "checkpoint"))
    try:
        sinks.finish(query)
    finally:
        spark.conf.set(stateful.STATE_STORE, before)
    # A customer's second row comes a day and a second after the first, which has just left its frame.
    got = {r.transaction_id: (int(r.rolling_24h_amount * 100), r.rolling_24h_count) for r in spark.read.parquet(str(tmp_path / "table")).collect()}
    assert got == {f"t{i}": (i, 1) for i in range(600)}
    held = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators if s.operatorName.startswith("transformWithState")]
    assert 0 < max(held) < 100


def test_split_state_adds_active_hours_not_windows(spark, tmp_path):
    """An hour is in no more state than its own and its group's, not in 24 windows; sums may exceed a long of cents."""
    before = spark.conf.get(stateful.STATE_STORE)
    spark.conf.set(stateful.STATE_STORE, stateful.ROCKSDB)
    start = datetime(2024, 1, 1)
    most = 10**18 - 1
    rows = [(f"s{i}", f"c{i % 90}", 61 * i, 7 * i - 500) for i in range(180)]  # over eight days
    rows += [(f"r{i}", "rich", 60 * i + i % 2, most) for i in range(110)]
    rows += [(f"n{i}", None, 30 + 200 * i, None if i % 3 else i) for i in range(40)]
    rows += [("a", "tie", 90, 1), ("b", "tie", 1530, 2), ("c", "tie", 1530, 3), ("d", "tie", 1531, 4)]
    schema = "transaction_id string, customer_id string, minute int, cents long"
    df = spark.createDataFrame([*rows, ("last", "end", 20000, 1)], schema).select(
        "transaction_id",
        "customer_id",
        F.timestamp_add("MINUTE", F.col("minute"), F.lit(start)).alias("transaction_timestamp"),
        (F.col("cents").cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)").alias("amount_eur"),
    )
    middle = F.col("transaction_timestamp") < F.lit(start + timedelta(hours=50))
    got, held = {}, {}
    for name, parts in {"at once": [F.lit(True)], "in two": [middle, ~middle]}.items():
        for part in parts:
            df.filter(part).coalesce(1).write.mode("append").parquet(str(tmp_path / name / "in"))
        stream = messages.file_stream(spark, str(tmp_path / name / "in"), df.schema, max_files_per_trigger=1)
        velocity = split.split_velocity(stream, groups=5)
        query = sinks.append_stream(velocity, str(tmp_path / name / "table"), str(tmp_path / name / "checkpoint"))
        sinks.finish(query)
        found = spark.read.schema(velocity.schema).parquet(str(tmp_path / name / "table")).collect()
        got[name] = sorted((r[1], r[0], r[2], int(r[3] * 100), r[4]) for r in found)
        progress = [s for p in query.recentProgress for s in p.stateOperators]
        held[name] = sum(s.numRowsUpdated for s in progress)
        assert all(s.numRowsTotal < 60 for s in query.lastProgress.stateOperators)
    spark.conf.set(stateful.STATE_STORE, before)
    want = []
    for t, c, m, _ in rows:
        frame = [a or 0 for _, other, at, a in rows if other == c and m - 1440 <= at <= m]
        want.append((t, c, start + timedelta(minutes=m), sum(frame), len(frame)))
    assert got["at once"] == got["in two"] == sorted(want, key=lambda r: r[0]) and max(r[3] for r in want) > 2**63
    # A window for each hour and row would be about 24 times the rows.
    assert max(held.values()) < 8 * len(rows)


def test_split_query_opens_few_stores(spark, x):
    """State partitions follow the cores, and the join has one store of a partition; the settings are put back."""
    settings = {key: spark.conf.get(key) for key in split.state_settings(spark)}
    root = Path(shared_dir(spark).removeprefix("file://"))
    known = set(root.glob("velocity-split-*"))
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        rows = streams.stream_velocity_split(x).count()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "20"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", settings["spark.sql.shuffle.partitions"])
    assert settings == {key: spark.conf.get(key) for key in settings}
    (run,) = set(root.glob("velocity-split-*")) - known
    stores = {file.parent for file in (run / "checkpoint/state").rglob("*.zip")}
    assert rows > 0 and len(stores) <= 4 * 2 * spark.sparkContext.defaultParallelism
