"""Count windows on a stream against a deque per driver, over slices and restarts."""

from __future__ import annotations

import random
from collections import deque

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from roadlens.streaming import count_windows as CW
from roadlens.streaming import jobs as J

SCHEMA = "driver_id string, event_id string, event_no long, distance_delta_km double, risk_event boolean, risk_score_event int, is_phone_usage boolean"


def events(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        driver = rng.choice(["A"] * 6 + ["B", "C", None])
        risk = rng.choice([True, False, False, None])
        rows.append((driver, f"E{i}", i, rng.choice([0.02, 0.05, None]), risk, None if risk is None else rng.randrange(4), rng.random() < 0.1))
    return rows


def run(spark, path, slices, n=12, every=10):
    J.use_rocksdb(spark)
    for part in slices:
        if part:
            spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").parquet(f"{path}/in")
        states = CW.buffer_states(spark.readStream.schema(SCHEMA).parquet(f"{path}/in"), n, every)
        q = states.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
    return spark.read.parquet(f"{path}/out")


def brute(rows, n):
    """(driver, event_no, next, count, km, risks, score, phones) of every buffer that a later event closes."""
    held, last, out = {}, {}, []
    total = lambda vs: None if all(v is None for v in vs) else sum(v for v in vs if v is not None)
    for driver, _, no, km, risk, score, phone in rows:
        if driver in last:
            out.append((driver, *last[driver][:1], no, *last[driver][1:]))
        d = held.setdefault(driver, deque(maxlen=n))
        d.append((km, None if risk is None else int(risk), score, int(phone)))
        sums = [total(c) for c in zip(*d)]
        last[driver] = (no, len(d), None if sums[0] is None else round(sums[0], 9), *sums[1:])
    return out, {d: v[0] for d, v in last.items()}


@pytest.mark.parametrize("n, every, cuts", [(12, 10, (137, 138)), (3, 7, (50, 200)), (1, 10, (100, 150))])
def test_closed_buffers_match_a_deque(spark, tmp_path, n, every, cuts):
    rows = events(300)
    got = run(spark, str(tmp_path), [rows[: cuts[0]], rows[cuts[0] : cuts[1]], [], rows[cuts[1] :]], n, every)
    closed = got.filter("status = 'closed'").select("driver_id", "event_no", "next_seq", "event_count", F.round("km_window", 9), "risk_event_count", "risk_score_window", "phone_usage_count")
    want, _ = brute(rows, n)
    assert sorted(map(tuple, closed.collect()), key=repr) == sorted(want, key=repr)
    assert {r.event_id for r in got.collect()} <= {r[1] for r in rows}


def test_a_tick_is_judged_without_waiting_for_the_drivers_next_event(spark, tmp_path):
    rows = events(100)
    got = run(spark, str(tmp_path), [rows[:45], rows[45:]], every=10)
    opened = {(r.driver_id, r.event_no, r.tick) for r in got.filter("status = 'open'").collect()}
    want = set()
    for end in (45, 100):
        _, last = brute(rows[:end], 12)
        want |= {(d, no, -(-no // 10) * 10) for d, no in last.items() if -(-no // 10) * 10 <= end}
    assert opened == want and opened


def test_sums_keep_nulls_and_order():
    tail = np.array([[0.1, np.nan], [0.2, np.nan]])
    counts, sums = CW.rolled(tail, np.array([[0.3, np.nan], [np.nan, 4.0]]), 3)
    assert counts.tolist() == [3, 3]
    assert sums[0, 0] == 0.1 + 0.2 + 0.3 and np.isnan(sums[0, 1]) and sums[1].tolist() == [0.2 + 0.3, 4.0]


class Held:
    """A state of one key, in memory."""

    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def put(self, value):
        self.value = value

    update = put

    def clear(self):
        self.value = []


class Expired:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at


def test_a_visit_costs_a_few_state_calls_and_old_timers_find_nothing():
    """Without a run between two slices the first timer is still there when the second comes: it must not judge the later buffer."""
    timers = []
    p = CW.LastEvents(12, 10)
    p.handle = type("Handle", (), {"registerTimer": staticmethod(timers.append)})()  # neither lists nor deletes
    p.tail, p.open = Held(), Held()
    p.tail.value = []
    frame = lambda numbers: pd.DataFrame({"event_id": [f"E{i}" if i % 3 else None for i in numbers], "seq": numbers, **{m: [None if i % 7 == 0 else i % 5 for i in numbers] for m in CW.MEASURES}}, dtype=object)
    first = list(p.handleInputRows(("A",), iter([frame([4, 1]), frame([13])]), None))
    assert [f[["seq", "next_seq", "status"]].to_numpy().tolist() for f in first] == [[[1, 4, "closed"], [4, 13, "closed"]]] and timers == [20]
    second = pd.concat(p.handleInputRows(("A",), iter([frame([25, 14])]), None))
    assert second[["seq", "next_seq", "event_count"]].to_numpy().tolist() == [[13, 14, 3], [14, 25, 4]] and timers == [20, 30]
    assert second["risk_event_count"].tolist() == [1 + 4 + 3, 1 + 4 + 3] and second["event_id"].tolist() == ["E13", "E14"]  # 14's measures are null
    assert list(p.handleExpiredTimer(("A",), None, Expired(20))) == []
    (judged,) = p.handleExpiredTimer(("A",), None, Expired(30))
    assert judged[["driver_id", "status", "tick", "seq", "event_count", "risk_event_count"]].to_numpy().tolist() == [["A", "open", 30, 25, 5, 8]]
    assert list(judged.columns) == list(CW.LastEvents.NAMES)


def test_columns_of_many_events_match_a_deque():
    rows = [r for r in events(4000, seed=5) if r[0] == "A"]
    p = CW.LastEvents(12, 10)
    p.handle = type("Handle", (), {"registerTimer": staticmethod(lambda at: None)})()
    p.tail, p.open = Held(), Held()
    p.tail.value, got = [], []
    for part in (rows[:1000], rows[1000:]):
        measures = {m: [None if r[c] is None else float(r[c]) for r in part] for m, c in zip(CW.MEASURES, (3, 4, 5, 6))}
        new = pd.DataFrame({"event_id": [r[1] for r in part], "seq": [r[2] for r in part], **measures})
        got += p.handleInputRows(("A",), iter([new]), None)
    got = pd.concat(got)[["driver_id", "seq", "next_seq", "event_count", "km_window", "risk_event_count", "risk_score_window", "phone_usage_count"]]
    want, _ = brute(rows, 12)
    assert [(*r[:4], None if pd.isna(r[4]) else round(r[4], 9), *(None if pd.isna(v) else v for v in r[5:])) for r in got.astype(object).to_numpy().tolist()] == want
