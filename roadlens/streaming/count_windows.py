"""The last N events of every driver, kept as state of a stream, and the decisions taken every K events.

Batch forms are in ``operators/rolling.py``; here the same features come while
events arrive.  A keyed processor holds, per driver,

* a list state of the measures of the last N-1 events, and
* the open buffer: the features after the driver's latest event, which stay
  current until its next one.

``seq`` is the arrival number of an event over the whole stream (offset + 1
of a topic).  It serves as the time axis: one event is one millisecond of the
watermark, so a timer can wait for "the next multiple of K events" although
the driver itself sends nothing.

Outputs of ``buffer_states``:

* ``closed`` -- when the driver's next event arrives: the features and the
  range [seq, next_seq) they were current in;
* ``open`` -- when a multiple of K passes first: the features that are judged
  at this tick (a decision must not wait for the driver's next event).

A buffer that closes leaves its timer: it finds a later buffer and does
nothing, which is cheaper than a list of timers at every visit.

State per driver is N rows, whatever the stream's length.  A driver's events of
one micro-batch meet in one task; the source's rate limit bounds them.  State
lives in RocksDB with the query's checkpoint, so a restart goes on from it.

Defined results: rows without a driver are one key like any other.  A null
measure counts as nothing; a sum over nothing is null, as in the batch form.
Rows with a number at or below the watermark (the highest of the batches
before) are late and dropped by Spark, as by any event-time operator; arrival
numbers of a topic never are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.rolling import ROLLING_DECISION_FIELDS, _measures, rolling_decision_columns
from ..operators.windows import window_decision_type
from ..session import reachable

MEASURES = ("m_km", "m_risk", "m_score", "m_phone")
SUMS = ("km_window", "risk_event_count", "risk_score_window", "phone_usage_count")
TAIL = "m_km double, m_risk double, m_score double, m_phone double"
BUFFER = "event_id string, seq long, event_count long, km_window double, risk_event_count long, risk_score_window long, phone_usage_count long"
FEATURES = tuple(f.split()[0] for f in BUFFER.split(", "))


def rolled(tail: np.ndarray, new: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums over the last ``n`` rows at each row of ``new``, after ``tail``; NaN is null.

    Added from the oldest row on, as a bounded frame is, so sums of decimals agree to the last bit.
    """
    rows = np.concatenate([tail, new])
    valid = ~np.isnan(rows)
    filled = np.where(valid, rows, 0.0)
    place = np.arange(len(tail), len(rows))
    sums, seen = np.zeros(new.shape), np.zeros(new.shape, int)
    for back in range(n - 1, -1, -1):
        has = place >= back
        sums[has] += filled[place[has] - back]
        seen[has] += valid[place[has] - back]
    return np.minimum(place + 1, n), np.where(seen > 0, sums, np.nan)


def _whole(values: np.ndarray) -> pd.api.extensions.ExtensionArray:
    """Whole numbers held as floats; NaN becomes null."""
    null = np.isnan(values)
    return pd.arrays.IntegerArray(np.where(null, 0, values).astype(np.int64), null)


class Buffers(NamedTuple):
    """The features after each of some events of a driver, as columns; NaN is null in ``sums`` (in the order of ``SUMS``)."""

    event_id: np.ndarray
    seq: np.ndarray
    count: np.ndarray
    sums: np.ndarray

    @classmethod
    def of(cls, held: tuple) -> "Buffers":
        """One buffer, of its row in the state."""
        event_id, seq, count, *sums = held
        sums = [np.nan if v is None else v for v in sums]
        return cls(np.array([event_id], object), np.array([seq], np.int64), np.array([count], np.int64), np.array([sums], float))

    def after(self, held: tuple) -> "Buffers":
        return Buffers(*(np.concatenate(pair) for pair in zip(Buffers.of(held), self)))

    def but_last(self) -> "Buffers":
        return Buffers(*(c[:-1] for c in self))

    def row(self, i: int) -> tuple:
        """The row of the state, in the order of ``BUFFER``."""
        event_id, (km, *whole) = self.event_id[i], self.sums[i].tolist()
        event_id = None if event_id is None or event_id != event_id else event_id
        return (event_id, int(self.seq[i]), int(self.count[i]), None if km != km else km, *(None if v != v else int(v) for v in whole))


class LastEvents(StatefulProcessor):
    """Per driver: the measures of the last ``n - 1`` events and the open buffer."""

    OUTPUT = "driver_id string, status string, tick long, next_seq long, " + BUFFER
    NAMES = tuple(f.split()[0] for f in OUTPUT.split(", "))

    def __init__(self, n: int, every: int):
        self.n, self.every = n, every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tail = handle.getListState("tail", TAIL)
        self.open = handle.getValueState("open", BUFFER)

    def _first_tick(self, seq: int) -> int:
        return -(-seq // self.every) * self.every

    def _frame(self, driver: Any, status: str, tick: Any, next_seq: Any, states: "Buffers") -> pd.DataFrame:
        """Output rows of ``states``, a column at a time; ``tick`` and ``next_seq`` are one number, an array or NaN."""
        n = len(states.seq)
        columns = [np.full(n, driver, object), np.full(n, status, object)]
        columns += [_whole(np.full(n, v, float)) if np.ndim(v) == 0 and v != v else np.broadcast_to(np.asarray(v, np.int64), n) for v in (tick, next_seq)]
        columns += [states.event_id, states.seq, states.count, states.sums[:, 0], *(_whole(v) for v in states.sums[:, 1:].T)]
        return pd.DataFrame(dict(zip(self.NAMES, columns)), copy=False)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        new = parts[0] if len(parts) == 1 else pd.concat(parts)
        seq = new["seq"].to_numpy(np.int64)
        order = np.argsort(seq, kind="stable")
        tail = np.array([tuple(np.nan if v is None else v for v in t) for t in self.tail.get()], float).reshape(-1, len(MEASURES))
        measures = np.column_stack([new[m].to_numpy(float, na_value=np.nan) for m in MEASURES])[order]
        states = Buffers(new["event_id"].to_numpy(object)[order], seq[order], *rolled(tail, measures, self.n))
        keep = np.concatenate([tail, measures])[max(0, len(tail) + len(measures) - self.n + 1) :] if self.n > 1 else measures[:0]
        self.tail.put([tuple(None if v != v else v for v in r) for r in keep.tolist()]) if len(keep) else self.tail.clear()
        before = self.open.get()
        if before is not None:
            states = states.after(before)
        self.open.update(states.row(-1))
        self.handle.registerTimer(self._first_tick(int(states.seq[-1])))
        if len(states.seq) > 1:
            yield self._frame(key[0], "closed", np.nan, states.seq[1:], states.but_last())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        """The open buffer is judged; the timer of a buffer that has closed since finds a later one and does nothing."""
        held, tick = self.open.get(), expiredTimerInfo.getExpiryTimeInMs()
        if held is not None and self._first_tick(held[1]) == tick:
            yield self._frame(key[0], "open", tick, np.nan, Buffers.of(held))

    def close(self) -> None:
        pass


def buffer_states(flagged: DataFrame, n: int = 12, every: int = 10, seq: str = "event_no") -> DataFrame:
    """Streaming (driver_id, status, tick, next_seq, event_id, <seq>, features) of ``flagged`` events; see the module's text."""
    reachable(flagged.sparkSession)
    number = F.col(seq).cast("long")
    rows = flagged.withColumns(_measures()).select(
        "driver_id",
        F.col("event_id").cast("string").alias("event_id"),
        number.alias("seq"),
        F.timestamp_millis(number).alias("at"),
        *[F.col(m).cast("double").alias(m) for m in MEASURES],
    )
    out = (
        rows.withWatermark("at", "0 seconds")
        .groupBy("driver_id")
        .transformWithStateInPandas(LastEvents(n, every), outputStructType=LastEvents.OUTPUT, outputMode="Append", timeMode="EventTime")
    )
    return out.withColumnRenamed("seq", seq)


def closed_tick_ranges(states: DataFrame, every: int = 10, seq: str = "event_no") -> DataFrame:
    """The tick ranges of the closed buffers that yield a decision: the rows of the batch form ``tick_decision_ranges``."""
    rows = states.filter("status = 'closed'").withColumns(
        {
            "first_tick": F.expr(f"(({seq} + {every} - 1) div {every}) * {every}"),
            "last_tick": F.expr(f"((next_seq - 1) div {every}) * {every}"),
        }
    )
    judged = _decided(rows.filter("first_tick <= last_tick"))
    return judged.withColumn("n_ticks", F.expr(f"(last_tick - first_tick) div {every} + 1")).select(
        "first_tick", "last_tick", "n_ticks", *ROLLING_DECISION_FIELDS
    )


def open_tick_decisions(states: DataFrame) -> DataFrame:
    """The decisions on buffers that are open when a tick passes first: ``tick`` and the decision's fields."""
    return _decided(states.filter("status = 'open'")).select("tick", *ROLLING_DECISION_FIELDS)


def _decided(states: DataFrame) -> DataFrame:
    rows = states.withColumn("risk_intensity_raw", F.col("risk_event_count") / F.col("event_count"))
    kind = window_decision_type("risk_score_window", "phone_usage_count", "event_count", "risk_intensity_raw", "risk_event_count", "km_window")
    rows = rows.withColumn("decision_type", kind).filter(F.col("decision_type").isNotNull()).withColumns(rolling_decision_columns())
    return rows.withColumns({"km_driven": F.round("km_window", 4), "risk_intensity": F.round("risk_intensity_raw", 3)})
