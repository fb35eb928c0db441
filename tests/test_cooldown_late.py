"""Decisions sent once per event and cooldown, and late rows kept, against plain loops over scripted slices."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F
from roadlens.sources import versions as V
from roadlens.streaming import cooldown as CD
from roadlens.streaming import jobs as J
from roadlens.streaming import late as LT

SCHEMA = "event_id string, driver_id string, event_time_ts timestamp, decision_type string"
START = dt.datetime(2026, 1, 1)


def rows(first, n, seed, gap=7):
    rng = random.Random(seed)
    return [(f"E{first + i:04d}", rng.choice(["A", "A", "B", None]), START + dt.timedelta(seconds=gap * (first + i) + rng.randrange(5)), "N") for i in range(n)]


def run(spark, path, slices, start):
    J.use_rocksdb(spark)
    for part in slices:
        if part:
            spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").parquet(f"{path}/in")
        q = start(spark.readStream.schema(SCHEMA).parquet(f"{path}/in"))
        q.awaitTermination()
        assert q.exception() is None


def sent_by_hand(decisions, cooldown):
    last, out = {}, []
    for r in sorted(set(decisions), key=lambda r: (r[2], r[0])):
        if r[1] not in last or (r[2] - last[r[1]]).total_seconds() >= cooldown:
            last[r[1]] = r[2]
            out.append(r)
    return sorted(out, key=repr)


def test_one_decision_per_driver_and_cooldown(spark, tmp_path):
    path = str(tmp_path)
    parts = [rows(0, 40, 1), rows(40, 40, 2), rows(80, 40, 3)]
    doubled = [[*p, *p[::2]] for p in parts]

    def start(stream):
        sent = CD.with_cooldown(CD.once_per_event(stream, "10 seconds"), 60)
        writer = sent.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/ck")
        return writer.trigger(availableNow=True).start()

    run(spark, path, [doubled[0], doubled[1], [], doubled[2]], start)
    got = sorted((tuple(r) for r in spark.read.parquet(f"{path}/out").collect()), key=repr)
    assert got == sent_by_hand([r for p in parts for r in p], 60) and 10 < len(got) < 60


def test_no_row_is_lost_and_late_rows_are_told_apart(spark, tmp_path):
    path = str(tmp_path)
    split = LT.LateSplit(f"{path}/split", 10_000)
    slices = [rows(50, 20, 4), [*rows(0, 10, 5), *rows(70, 5, 6)], [("none", "A", None, "N"), *rows(72, 6, 7), *rows(30, 3, 8)], []]
    run(spark, path, slices, lambda s: LT.start_late_split(s, split, f"{path}/ck", {"availableNow": True}))
    schema = spark.createDataFrame([], SCHEMA).schema
    high, want = None, {"on_time": set(), "late": set()}
    for part in slices:
        for r in part:
            on_time = r[2] is not None and (high is None or r[2] >= high - dt.timedelta(seconds=10))
            want["on_time" if on_time else "late"].add(r[0])
        high = max([r[2] for r in part if r[2]] + ([high] if high else []), default=None)
    for kind, ids in want.items():
        assert {r.event_id for r in split.read(spark, kind, schema).collect()} == ids and ids
    assert sum(split.read(spark, k, schema).count() for k in want) == sum(map(len, slices))


def test_a_replayed_batch_is_parted_in_the_same_way(spark, tmp_path):
    split = LT.LateSplit(str(tmp_path / "s"), 0)
    df = lambda part: spark.createDataFrame(part, SCHEMA)
    split.write_batch(df(rows(10, 5, 1)), 0)
    for _ in range(2):
        split.write_batch(df([*rows(0, 3, 2), *rows(40, 3, 3)]), 1)
    schema = df([]).schema
    assert split.read(spark, "late", schema).count() == 3 and split.read(spark, "on_time", schema).count() == 8
    assert V.versions(spark, f"{split.path}/watermarks") == [0, 1]
    assert split.watermark(spark, 0) is None
    assert split.read(spark, "on_time", schema).agg(F.max("event_id")).first()[0] == "E0042"
