"""Decisions sent once: duplicates of an event are dropped, and a driver is left alone for a while after a decision.

* ``once_per_event``: a message that comes twice within the watermark's delay
  is one event (``dropDuplicatesWithinWatermark``; its state ends with the
  watermark).
* ``with_cooldown``: of a driver's decisions, in the order of their event
  times, one is sent if none was sent in the ``cooldown`` before it.  The state
  is one instant per driver; a timer on the event time clears it when the
  cooldown has passed, so drivers that fall silent leave nothing behind.

Defined results: decisions of one instant are ordered by event id, and the
first is sent.  Decisions without a driver are one key like any other; those
without an event time cannot be placed and are not sent.  A decision behind
the watermark is late and dropped, as by any event-time operator; ``late.py``
keeps such rows.  A driver's decisions of one micro-batch meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..session import reachable


def once_per_event(events: DataFrame, watermark: str, id_col: str = "event_id", time_col: str = "event_time_ts") -> DataFrame:
    """The stream without repeated events; sets the watermark."""
    return events.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark([id_col])


class Cooldown(StatefulProcessor):
    """Per driver: the event time of the decision sent last, in milliseconds."""

    def __init__(self, cooldown_ms: int, columns: list[str]):
        self.cooldown_ms, self.columns = cooldown_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sent = handle.getValueState("sent", "at long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).dropna(subset=["at_ms"]).sort_values(["at_ms", "event_id"], kind="stable")
        held = self.sent.get()
        last = before = None if held is None else held[0]
        keep = []
        for at in new["at_ms"].tolist():
            keep.append(last is None or at >= last + self.cooldown_ms)
            last = at if keep[-1] else last
        if last != before:
            if before is not None:
                self.handle.deleteTimer(before + self.cooldown_ms)
            self.sent.update((int(last),))
            self.handle.registerTimer(int(last) + self.cooldown_ms)
        out = new[keep]
        if len(out):
            yield out[self.columns]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.sent.clear()
        return iter(())

    def close(self) -> None:
        pass


def with_cooldown(decisions: DataFrame, cooldown_s: int, time_col: str = "event_time_ts") -> DataFrame:
    """The decisions that are sent, of a stream with a watermark on ``time_col`` and columns ``driver_id`` and ``event_id``."""
    reachable(decisions.sparkSession)
    schema = StructType(decisions.schema.fields)
    rows = decisions.withColumn("at_ms", F.unix_millis(time_col))
    processor = Cooldown(cooldown_s * 1000, schema.fieldNames())
    return rows.groupBy("driver_id").transformWithStateInPandas(processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")
