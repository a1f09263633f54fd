"""Trailing velocity per transaction with keyed state, for low-latency streams.

The state of a customer is kept per time slice: small totals for every slice of
the frame, and the single rows of a slice, which are only fetched for the slices
at the two edges of a frame.

One call handles what one trigger brought for one customer, so the source must
be rate-limited (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``). To catch up
on a large backlog use ``medallion.velocity_handler``, which spreads a busy
customer over many tasks.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

OUTPUT = (
    "customer_id string, transaction_id string, transaction_timestamp timestamp, "
    "rolling_24h_amount decimal(38,2), rolling_24h_count bigint"
)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _processor(hours: int, slice_minutes: int) -> StatefulProcessor:
    slice_us = slice_minutes * 60_000_000
    frame_us = hours * 3_600_000_000
    slices = frame_us // slice_us
    none = np.empty(0, np.int64)

    # Defined here rather than at module level so that the whole processor is
    # shipped with the query and executors need no copy of this package.
    class TrailingVelocity(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.totals = handle.getMapState("totals", "slice bigint", "cents bigint, n bigint")
            self.rows = handle.getMapState("rows", "slice bigint", "at array<bigint>, cents array<bigint>")

        def handleInputRows(self, key, rows, timerValues):
            batch = pd.concat(rows, ignore_index=True)
            at = batch["at"].to_numpy(np.int64)
            cents = batch["cents"].to_numpy(np.int64)
            where = at // slice_us
            touched = [int(s) for s in np.unique(where)]

            stored = {int(k[0]): (int(v[0]), int(v[1])) for k, v in self.totals.iterator()}
            pieces = {}
            for s in {*touched, *(t - slices for t in touched)} & stored.keys():
                had_at, had_cents = self.rows.getValue((s,))
                pieces[s] = (np.array(had_at, np.int64), np.array(had_cents, np.int64))
            for s in touched:
                mine, had = where == s, pieces.get(s, (none, none))
                pieces[s] = (np.concatenate([had[0], at[mine]]), np.concatenate([had[1], cents[mine]]))
            totals = {**stored, **{s: (int(pieces[s][1].sum()), len(pieces[s][0])) for s in touched}}

            amount, count = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
            for s in touched:
                mine = where == s
                full = [totals[f] for f in range(s - slices + 1, s) if f in totals]
                base = np.array(full, np.int64).reshape(-1, 2).sum(axis=0)
                old, here = self._running(pieces.get(s - slices)), self._running(pieces[s])
                out_s, out_n = self._up_to(old, at[mine] - frame_us, "left")
                in_s, in_n = self._up_to(here, at[mine], "right")
                amount[mine] = base[0] + old[1][-1] - out_s + in_s
                count[mine] = base[1] + len(old[0]) - out_n + in_n

            self._remember(touched, pieces, totals, stored, int(at.max()))
            result = batch[["transaction_id", "transaction_timestamp"]].copy()
            result.insert(0, "customer_id", key[0])
            result["rolling_24h_amount"] = [Decimal(c).scaleb(-2) for c in amount.tolist()]
            result["rolling_24h_count"] = count
            yield result

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            """Forget a customer that was idle for a whole frame."""
            self.totals.clear()
            self.rows.clear()
            return iter([])

        def _remember(self, touched, pieces, totals, stored, newest_at) -> None:
            # One extra frame is kept for rows that arrive late.
            oldest = max(totals) - 2 * slices
            for s in touched:
                if s >= oldest:
                    self.rows.updateValue((s,), tuple(part.tolist() for part in pieces[s]))
                    self.totals.updateValue((s,), totals[s])
            for s in stored:
                if s < oldest:
                    self.rows.removeKey((s,))
                    self.totals.removeKey((s,))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((newest_at + 2 * frame_us) // 1000)

        def _running(self, piece):
            """Times of a slice in order, and running totals with a leading 0."""
            times, values = piece if piece is not None else (none, none)
            order = np.argsort(times, kind="stable")
            return times[order], np.concatenate([[0], np.cumsum(values[order])])

        def _up_to(self, running, moments, side):
            """Sum and number of the entries before (left) or up to (right) each moment."""
            position = np.searchsorted(running[0], moments, side=side)
            return running[1][position], position

        def close(self) -> None:
            pass

    return TrailingVelocity()


def stateful_velocity(
    df: DataFrame,
    lateness: str = "2 hours",
    hours: int = 24,
    slice_minutes: int = 10,
    amount: str = "amount_eur",
) -> DataFrame:
    """Each transaction with its trailing amount and count, as soon as it arrives.

    Needs the RocksDB state store (set ``STATE_STORE`` to ``ROCKSDB``). A row counts what was seen up to its batch;
    rows later than the lateness bound belong in ``merge.newest_wins`` instead.
    """
    ts = "transaction_timestamp"
    narrow = df.withWatermark(ts, lateness).select(
        "customer_id",
        "transaction_id",
        ts,
        F.unix_micros(ts).alias("at"),
        (F.col(amount) * 100).cast("bigint").alias("cents"),
    )
    return narrow.groupBy("customer_id").transformWithStateInPandas(
        statefulProcessor=_processor(hours, slice_minutes),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="EventTime",
    )
