"""Trailing velocity on a stream with state that splits a busy customer by time.

A transaction's trailing frame is taken apart at hour borders. The whole hours,
its own included, are added up per customer in the JVM (``windows.hourly_totals``),
and a keyed step adds the 24 hours of a frame, at the customer's active hours
alone, so that an hour is not copied into 24 windows. What these hours count too
much, the customer's later rows in the same hour, and too little, the rows of the
hour one day before that are not yet a day old, is found by a second keyed step,
which keeps every row once, under its hour, until the hour one day later is over.

Keys are groups of customers: one call answers all customers of the group. So the
largest thing that any task holds is one group's rows of two hours or its hours of
a few days, and the number of calls follows the hours and groups, not the customers.
Both steps send an hour of a group on as compressed Arrow streams, and only these
are joined.

Answers come once the watermark has passed the hour, and then count every row
that was not too late. For answers within the batch there are
``medallion.velocity_handler`` and, for evenly spread customers,
``stateful.stateful_velocity``.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from .stateful import ROCKSDB, STATE_STORE
from .windows import LATENESS, hourly_totals

FRAME_HOURS = 24
# Hours that one key of the frames holds; the last of them are carried into the next key as well.
SPAN_HOURS = 96
# Rows put into one Arrow stream at most.
PART_ROWS = 200_000
# Sums of cents are held in two numbers, ``high`` of this many cents and ``low``, so that they do not run over.
HIGH = 10**12
EDGES = "group int, hour_time timestamp, rows binary"
FRAMES = "group int, window_time timestamp, totals binary"
ANSWERS = "customer_id string, transaction_id string, at bigint, high bigint, low bigint, count bigint"


def state_settings(spark: SparkSession) -> dict[str, str]:
    """Settings to start the stream with; its checkpoint keeps them.

    Every partition of every state opens a store of its own, with 4 MB on disk whatever
    it holds. So partitions follow the cores, and the join has one store of a partition, not four.
    """
    partitions = "spark.sql.shuffle.partitions"
    most = 2 * spark.sparkContext.defaultParallelism
    return {
        STATE_STORE: ROCKSDB,
        "spark.sql.streaming.join.stateFormatVersion": "3",
        partitions: str(min(int(spark.conf.get(partitions)), most)),
    }


def _steps(frame_hours: int, span_hours: int, part_rows: int):
    """The two keyed steps, and the function that answers what their join has brought together."""
    hour_us, hour_ms = 3_600_000_000, 3_600_000

    # All is defined here so that it is shipped with the query.
    def packed(frame):
        table = pa.Table.from_pandas(frame, preserve_index=False).replace_schema_metadata()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_table(table)
        return sink.getvalue().to_pybytes()

    def unpacked(entry):
        return pa.ipc.open_stream(bytes(entry)).read_pandas()

    def by_hour(frame, hours):
        """The hours of a frame's rows, each with its rows."""
        order = np.argsort(hours, kind="stable")
        found, starts = np.unique(hours[order], return_index=True)
        for hour, places in zip(found.tolist(), np.split(order, starts[1:]), strict=True):
            yield hour, frame.iloc[places]

    def end_of(hours):
        """The event time of rows of these hours."""
        return pd.to_datetime((np.asarray(hours, np.int64) + 1) * hour_us - 1, unit="us")

    def running(values, order):
        return np.concatenate([[0], np.cumsum(values.to_numpy(np.int64)[order])])

    class Edges(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            # The rows of an hour, in parts that are an Arrow stream each; and what there is of an hour.
            self.rows = handle.getMapState("rows", "hour bigint, part int", "rows binary")
            self.hours = handle.getMapState("hours", "hour bigint", "parts int, n bigint, answered boolean")

        def handleInputRows(self, key, rows, timerValues):
            waiting, many = [], 0
            for batch in rows:
                waiting.append(batch[["customer_id", "transaction_id", "at", "cents"]])
                many += len(batch)
                if many >= part_rows:
                    self._keep(waiting)
                    waiting, many = [], 0
            if many:
                self._keep(waiting)
            return iter([])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            """Answer the rows of all hours that are over, and forget those that no later frame ends in."""
            first_open = int(timerValues.getCurrentWatermarkInMs()) // hour_ms
            hours = {int(k[0]): (int(v[0]), int(v[1]), bool(v[2])) for k, v in self.hours.iterator()}
            due = sorted(h for h, (_, _, answered) in hours.items() if h < first_open and not answered)
            for some in self._bounded(due, hours):
                over, parts = zip(*self._answered(some, hours), strict=True)
                yield pd.DataFrame({"group": int(key[0]), "hour_time": end_of(over), "rows": parts})
            left = []
            for hour, (parts, n, answered) in hours.items():
                if hour + frame_hours < first_open:
                    for part in range(parts):
                        self.rows.removeKey((hour, part))
                    self.hours.removeKey((hour,))
                else:
                    if hour < first_open and not answered:
                        self.hours.updateValue((hour,), (parts, n, True))
                    left.append(hour + 1 if hour >= first_open else hour + 1 + frame_hours)
            if left:
                self.handle.registerTimer(min(left) * hour_ms)

        def _keep(self, frames):
            frame = pd.concat(frames, ignore_index=True)
            split = list(by_hour(frame, frame["at"].to_numpy(np.int64) // hour_us))
            for hour, rows in split:
                parts, n, answered = self.hours.getValue((hour,)) or (0, 0, False)
                self.rows.updateValue((hour, int(parts)), (packed(rows),))
                self.hours.updateValue((hour,), (int(parts) + 1, int(n) + len(rows), bool(answered)))
            self.handle.registerTimer((split[0][0] + 1) * hour_ms)

        def _bounded(self, due, hours):
            """The hours in runs of a few days or of so many rows, the hours one frame before included."""
            some, many = [], 0
            for hour in due:
                n = sum(hours[h][1] for h in (hour, hour - frame_hours) if h in hours)
                if some and (many + n > part_rows or hour - some[0] >= 32 * frame_hours):
                    yield some
                    some, many = [], 0
                some.append(hour)
                many += n
            if some:
                yield some

        def _answered(self, some, hours):
            """The rows of these hours with their edges: an hour, and a part of its rows."""
            needed = sorted({*some, *(h - frame_hours for h in some)} & hours.keys())
            read = {h: [unpacked(self.rows.getValue((h, part))[0]) for part in range(hours[h][0])] for h in needed}
            rows = pd.concat([part for h in needed for part in read[h]], ignore_index=True)
            at = rows["at"].to_numpy(np.int64)
            hour = at // hour_us
            # A place is a customer's stretch of hours, in it the hour, and in that the moment.
            first = some[0] - frame_hours
            slots = (some[-1] - first) // frame_hours + 1
            code = pd.factorize(rows["customer_id"], use_na_sentinel=False)[0].astype(np.int64)
            start = (code * slots + (hour - first) // frame_hours) * hour_us
            places = start + at - hour * hour_us
            own = np.flatnonzero(np.isin(hour, some))
            order = np.argsort(places, kind="stable")
            before = running(rows["cents"], order)
            here, start, places = places[own], start[own], places[order]
            later = self._from(before, places, here, "right", start + hour_us)
            still = self._from(before, places, here - hour_us, "left", start)
            answers = rows.iloc[own][["customer_id", "transaction_id", "at"]].assign(
                edge_cents=still[0] - later[0], edge_count=still[1] - later[1]
            )
            return [
                (h, packed(frame.iloc[low : low + part_rows]))
                for h, frame in by_hour(answers, hour[own])
                for low in range(0, len(frame), part_rows)
            ]

        def _from(self, before, places, moments, side, ends):
            """Sum and number of the rows after (right) or from (left) each moment up to its end."""
            low = np.searchsorted(places, moments, side=side)
            high = np.searchsorted(places, ends, side="left")
            return before[high] - before[low], high - low

        def close(self) -> None:
            pass

    class Frames(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            # The totals of an hour's customers, as an Arrow stream.
            self.hours = handle.getMapState("hours", "hour bigint", "totals binary")

        def handleInputRows(self, key, rows, timerValues):
            """Hours come when they are over, so all that their frames count has come as well."""
            first, over = int(key[1]) * span_hours, (int(key[1]) + 1) * span_hours
            new = pd.concat(list(rows), ignore_index=True)
            stored = {int(hour[0]): unpacked(entry[0]) for hour, entry in self.hours.iterator()}
            known = pd.concat([new[["customer_id", "hour", "high", "low", "n"]], *stored.values()], ignore_index=True)
            # One stretch of places per customer; a frame of the span's first hour does not leave it.
            stretch = span_hours + frame_hours
            code = pd.factorize(known["customer_id"], use_na_sentinel=False)[0].astype(np.int64)
            places = code * stretch + (known["hour"].to_numpy(np.int64) - first + frame_hours)
            order = np.argsort(places, kind="stable")
            own = np.flatnonzero(~new["carried"].to_numpy(bool))
            moments, places = places[own], places[order]
            low = np.searchsorted(places, moments - frame_hours + 1, side="left")
            high = np.searchsorted(places, moments, side="right")
            totals = new.iloc[own][["customer_id", "hour"]].reset_index(drop=True)
            for column in ("high", "low", "n"):
                before = running(known[column], order)
                totals[column] = before[high] - before[low]
            if len(own):
                answered = [
                    (hour, packed(frame[["customer_id", "high", "low", "n"]]))
                    for hour, frame in by_hour(totals, totals["hour"].to_numpy(np.int64))
                ]
                hours, entries = zip(*answered, strict=True)
                yield pd.DataFrame({"group": int(key[0]), "window_time": end_of(hours), "totals": entries})
            self._remember(new, stored, int(timerValues.getCurrentWatermarkInMs()) // hour_ms, over)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            """The span is over."""
            self.hours.clear()
            return iter([])

        def _remember(self, new, stored, first_open, over):
            """Keep the hours that are in the frame of an hour of the span that is still open."""
            oldest = first_open - frame_hours + 1 if first_open < over else over
            for hour in stored:
                if hour < oldest:
                    self.hours.removeKey((hour,))
            for hour, frame in by_hour(new, new["hour"].to_numpy(np.int64)):
                if hour >= oldest:
                    frame = frame[["customer_id", "hour", "high", "low", "n"]]
                    if hour in stored:
                        frame = pd.concat([stored[hour], frame], ignore_index=True)
                    self.hours.updateValue((hour,), (packed(frame),))
                    self.handle.registerTimer(over * hour_ms)

        def close(self) -> None:
            pass

    def answers(batches):
        for batch in batches:
            for totals, rows in zip(batch["totals"], batch["rows"], strict=True):
                found = unpacked(rows).merge(unpacked(totals), on="customer_id")
                yield pd.DataFrame(
                    {
                        "customer_id": found["customer_id"],
                        "transaction_id": found["transaction_id"],
                        "at": found["at"],
                        "high": found["high"],
                        "low": found["low"] + found["edge_cents"],
                        "count": found["n"] + found["edge_count"],
                    }
                )

    return Edges(), Frames(), answers


def split_velocity(
    df: DataFrame, lateness: str = LATENESS, amount: str = "amount_eur", groups: int = 16
) -> DataFrame:
    """customer_id, transaction_id, transaction_timestamp, rolling_24h_amount, rolling_24h_count of every transaction.

    Both parts drop the same late rows, those whose whole hour the watermark has
    passed; ``late`` looks after them. Timers clear an hour's rows and a span's hours,
    and the watermark clears hourly totals and join. Rows without a customer are one
    customer's; an amount that is missing counts as 0. Needs the RocksDB state store.

    ``groups``: how many groups the customers are dealt into by hash. A call into Python
    answers one group's hour, so it should be large enough that such an hour fits a task.
    """
    ts = "transaction_timestamp"
    edges_step, frames_step, answers = _steps(FRAME_HOURS, SPAN_HOURS, PART_ROWS)
    group = F.pmod(F.xxhash64("customer_id"), F.lit(groups)).cast("int").alias("group")
    hour = F.expr("(at - pmod(at, 3600000000)) div 3600000000")
    row = df.withWatermark(ts, lateness).select(
        group,
        "customer_id",
        "transaction_id",
        F.window_time(F.window(ts, "1 hour")).alias("hour_time"),
        F.unix_micros(ts).alias("at"),
        F.coalesce((F.col(amount) * 100).cast("bigint"), F.lit(0)).alias("cents"),
    )
    # A row and the hour that it leaves the frame in have the same key, so a row is sent and kept once.
    edges = (
        row.withColumn("hour_of_frame", F.pmod(hour, F.lit(FRAME_HOURS)).cast("int"))
        .groupBy("group", "hour_of_frame")
        .transformWithStateInPandas(
            statefulProcessor=edges_step,
            outputStructType=EDGES,
            outputMode="Append",
            timeMode="EventTime",
            eventTimeColumnName="hour_time",
        )
    )
    hours = hourly_totals(df.withColumn(amount, F.coalesce(amount, F.lit(0))), lateness, ts, amount).select(
        group,
        "customer_id",
        "hour_time",
        F.unix_micros("hour_time").alias("at"),
        (F.col("hour_amount") * 100).cast("decimal(38,0)").alias("cents"),
        F.col("hour_count").alias("n"),
    )
    high = F.expr(f"cents div {HIGH}BD").alias("high")
    low = F.expr(f"cents % {HIGH}BD").cast("bigint").alias("low")
    span = F.expr(f"(hour - pmod(hour, {SPAN_HOURS})) div {SPAN_HOURS}")
    last = F.pmod("hour", F.lit(SPAN_HOURS)) > SPAN_HOURS - FRAME_HOURS
    roles = F.explode(F.when(last, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    totals = (
        hours.withColumn("hour", hour)
        .select("group", "customer_id", "hour_time", "hour", high, low, "n", roles.alias("carried"))
        .withColumn("span", span + F.col("carried").cast("bigint"))
        .groupBy("group", "span")
        .transformWithStateInPandas(
            statefulProcessor=frames_step,
            outputStructType=FRAMES,
            outputMode="Append",
            timeMode="EventTime",
            eventTimeColumnName="window_time",
        )
        .withColumnRenamed("group", "window_group")
    )
    # The totals are the side that waits in the join: they are one row of an hour and group.
    same = (F.col("group") == F.col("window_group")) & (F.col("hour_time") == F.col("window_time"))
    found = totals.join(edges, same, "inner").select("totals", "rows").mapInPandas(answers, ANSWERS)
    cents = F.col("high").cast("decimal(20,0)") * F.lit(Decimal(HIGH)) + F.col("low")
    return found.select(
        "customer_id",
        "transaction_id",
        F.timestamp_micros("at").alias(ts),
        (cents * F.lit(Decimal("0.01"))).cast("decimal(38,2)").alias("rolling_24h_amount"),
        F.col("count").alias("rolling_24h_count"),
    )
