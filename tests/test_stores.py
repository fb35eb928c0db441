"""Tables that are kept up to date: premium snapshot, partial roll-ups, keyed tables; layouts of the feature table."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F
from roadlens.operators import pricing as P
from roadlens.operators import reports as R
from roadlens.schemas import PREMIUM_HISTORY_SCHEMA
from roadlens.sources import io as IO
from roadlens.sources import premium_snapshot as PS
from roadlens.sources import rollup_store as RS
from roadlens.sources import versions as V
from roadlens.streaming.upsert import KEPT, KeyedTable


def plan_of(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def premiums(spark, rows):
    df = spark.createDataFrame(rows, "driver_id string, scored_at string, technical_premium double")
    return P.conform_history(df)


RUNS = [
    [("D1", "2026-01-01T00:00:00+00:00", 1.0), ("D2", "2026-01-01T00:00:00+00:00", 2.0), (None, "2026-01-01T00:00:00+00:00", 9.0)],
    [("D1", "2026-01-03T00:00:00+00:00", 3.0), ("D3", "n/a", 4.0)],
    [("D1", "2026-01-02T00:00:00+00:00", 5.0), ("D2", "2026-01-01T01:00:00+02:00", 6.0), ("D3", "2025-01-01T00:00:00+00:00", 7.0), ("D4", None, 8.0)],
]


def test_snapshot_equals_the_latest_premium_of_the_history(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    assert PS.read_snapshot(spark, path) is None
    with pytest.raises(FileNotFoundError):
        PS.lookup(spark, path, "D1")
    history = None
    for rows in [*RUNS, RUNS[1]]:
        run = premiums(spark, rows)
        PS.merge_run(run, path, buckets=4)
        history = P.union_history(history, run)
        want = P.latest_premium(history.filter("driver_id IS NOT NULL")).select(*PREMIUM_HISTORY_SCHEMA.fieldNames())
        assert sorted(map(tuple, PS.read_snapshot(spark, path).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert [r.technical_premium for r in PS.lookup(spark, path, "D1").collect()] == [3.0]
    assert PS.lookup(spark, path, "D9").collect() == []
    assert V.versions(spark, f"{path}/versions") == [2, 3]


def test_a_lookup_reads_one_bucket_and_a_merge_does_not_shuffle_the_snapshot(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    PS.merge_run(premiums(spark, [(f"D{i}", "2026-01-01T00:00:00+00:00", float(i)) for i in range(200)]), path, buckets=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else the plan does not show the buckets it picks
    try:
        assert "SelectedBucketsCount: 1 out of 16" in plan_of(PS.lookup(spark, path, "D17"))
        plan = plan_of(PS.merged(PS.read_snapshot(spark, path), premiums(spark, RUNS[1])))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    tree = plan.split("\n\n")[0].splitlines()
    join = next(i for i, line in enumerate(tree) if "SortMergeJoin" in line)
    scan = next(i for i, line in enumerate(tree) if i > join and "Scan parquet" in line)
    assert not any("Exchange" in line for line in tree[join:scan]) and any("Exchange" in line for line in tree[scan:])


def features(spark, hours):
    rows = [(f"D{i % 7}" if i % 11 else None, f"2026-01-01T{h:02d}", 0.001 * i + 0.1, i % 5, i % 3, float(i % 4) / 4, None if i % 6 == 0 else 0.5, 0.25, i % 2) for h in hours for i in range(h * 40, h * 40 + 40)]
    return spark.createDataFrame(
        rows,
        "driver_id string, window_hour string, exposure_km double, hard_braking_count long, harsh_acceleration_count long, "
        "speeding_ratio double, night_event_ratio double, bad_weather_event_ratio double, phone_usage_count long",
    )


def test_topped_up_roll_up_equals_the_full_one(spark, tmp_path):
    path, store = str(tmp_path / "features"), str(tmp_path / "rollup")
    for hours in ([0, 1], [1, 2], [4]):  # hour 1 was still open at the first top-up
        features(spark, hours).write.mode("append").partitionBy("window_hour").parquet(path)
        RS.top_up(spark, path, store, "window_hour")
        RS.top_up(spark, path, store, "window_hour")
        full = P.driver_rollup(P.prepare_features(IO.load_features(spark, path)))
        rounded = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
        assert rounded(RS.stored_rollup(spark, store).select(*full.columns)) == rounded(full)


def test_a_top_up_reads_new_periods_only(spark, tmp_path):
    path, store = str(tmp_path / "features"), str(tmp_path / "rollup")
    features(spark, [0, 1]).write.partitionBy("window_hour").parquet(path)
    RS.top_up(spark, path, store, "window_hour")
    features(spark, [2]).write.mode("append").partitionBy("window_hour").parquet(path)
    new = RS.new_periods(spark, path, store, "window_hour")
    assert {r.window_hour for r in new.select("window_hour").distinct().collect()} == {"2026-01-01T01", "2026-01-01T02"}
    assert "PartitionFilters: [isnotnull(window_hour" in plan_of(new)


def keyed(spark, path, buckets=4):
    schema = spark.createDataFrame([], "driver_id string, window_start long, n long").schema
    return KeyedTable(path, ("driver_id", "window_start"), schema, buckets)


def test_keyed_table_keeps_the_latest_row_and_ignores_replays(spark, tmp_path):
    table = keyed(spark, str(tmp_path / "t"))
    assert table.read(spark).collect() == []
    want = {}
    for batch in range(12):
        rows = [(f"D{(batch * 7 + i) % 9}" if i else None, i % 5, batch * 100 + i) for i in range(6)]
        df = spark.createDataFrame(rows, table.schema)
        table.merge_batch(df, batch)
        want |= {(d, w): n for d, w, n in rows}
        if batch % 3 == 0:  # replayed whole: nothing changes
            table.merge_batch(df.withColumn("n", F.col("n") + 1), batch)
        assert {(r.driver_id, r.window_start): r.n for r in table.read(spark).collect()} == want
    table.merge_batch(spark.createDataFrame([], table.schema), 12)
    assert {(r.driver_id, r.window_start): r.n for r in table.read(spark).collect()} == want
    assert len(V.versions(spark, f"{table.path}/versions")) == KEPT + 1


def test_keyed_table_reads_no_old_batch_and_survives_a_dead_one(spark, tmp_path):
    table = keyed(spark, str(tmp_path / "t"), buckets=1)
    for batch in range(8):
        table.merge_batch(spark.createDataFrame([("D1", 0, batch), (f"D{batch}", 1, batch)], table.schema), batch)
    files = {f.split("/data/")[1].split("/")[0] for f in table.read(spark).inputFiles()}
    assert files == {"batch=7"}
    left = sorted(p.name for p in (tmp_path / "t/data").iterdir() if any(p.rglob("part-*")))
    assert left == ["batch=5", "batch=6", "batch=7"]
    # a batch that died after its files were written: its folder is not part of the table and is written again
    spark.createDataFrame([("D1", 0, 99)], table.schema).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{table.path}/data/batch=8")
    assert {r.n for r in table.read(spark).filter("window_start = 0").collect()} == {7}
    table.merge_batch(spark.createDataFrame([("D1", 0, 8)], table.schema), 8)
    assert {r.n for r in table.read(spark).filter("window_start = 0").collect()} == {8}


def test_one_row_per_key_of_a_batch(spark, tmp_path):
    table = keyed(spark, str(tmp_path / "t"))
    table.merge_batch(spark.createDataFrame([("D1", 0, 1), ("D1", 0, 3), ("D1", 0, 2)], table.schema), 0)
    assert [r.n for r in table.read(spark).collect()] == [3]


def test_a_version_is_published_once(spark, tmp_path):
    V.publish(spark, str(tmp_path), 3, {"a": 1})
    with pytest.raises(RuntimeError, match="already"):
        V.publish(spark, str(tmp_path), 3, {"a": 2})
    assert V.current(spark, str(tmp_path)) == (3, {"a": 1})


def test_feature_files_of_several_layouts_lose_no_column(spark, tmp_path):
    path = str(tmp_path / "features")
    spark.createDataFrame([("D1", 1.0)], "driver_id string, exposure_km double").write.parquet(path)
    spark.createDataFrame([(0.5, "D2", 2.0, "x")], "speeding_ratio double, driver_id string, exposure_km double, fleet string").write.mode("append").parquet(path)
    got = IO.load_features(spark, path).select("driver_id", "exposure_km", "speeding_ratio", "fleet").collect()
    assert sorted(map(tuple, got)) == [("D1", 1.0, None, None), ("D2", 2.0, 0.5, "x")]
    spark.createDataFrame([("D3", "odd")], "driver_id string, exposure_km string").write.mode("append").parquet(path)
    with pytest.raises(Exception, match="(?i)merge"):
        IO.load_features(spark, path).collect()


def test_trajectory_takes_odd_stamps(spark):
    history = premiums(spark, [("D1", "n/a", 1.0), ("D1", "2026-01-02T00:00:00+00:00", 3.0), ("D1", "2026-01-01T00:00:00+00:00", 2.0), ("D1", None, 4.0)])
    assert [r.scored_at for r in R.trajectory(history).collect()] == [None, "n/a", "2026-01-01T00:00:00+00:00", "2026-01-02T00:00:00+00:00"]
