"""Structured Streaming: watermark and late rows (T13, T14), restart from checkpoint, several queries at once."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from conftest import event_row
from roadlens.config import JobConfig
from roadlens.session import scratch_path
from roadlens.streaming import jobs as J

TRIGGER = {"availableNow": True}


def _write_batch(spark, folder, times, prefix):
    rows = [
        (ev["driver_id"], json.dumps(ev))
        for ev in (event_row(event_id=f"{prefix}{i}", event_time=t) for i, t in enumerate(times))
    ]
    spark.createDataFrame(rows, "key string, value string").write.mode("append").parquet(folder)


def _setup(spark, name):
    root = scratch_path(spark, name)
    cfg = J.with_paths(JobConfig(), root, f"{root}/input")
    return cfg, J.StreamSinks("parquet", f"{root}/topics")


def test_watermark_accepts_late_rows_within_delay_and_drops_older(spark):
    cfg, _ = _setup(spark, "late")
    # batch 1: max 00:02:50 -> watermark 00:02:20
    _write_batch(spark, cfg.source_path, ["2026-01-01T00:00:10.000Z", "2026-01-01T00:01:10.000Z", "2026-01-01T00:02:50.000Z"], "a")
    J.run_until_done([J.start_features(spark, cfg, TRIGGER)])
    # batch 2: 00:02:30 is late but newer than the watermark -> counted; 00:05:00 moves the watermark to 00:04:30
    _write_batch(spark, cfg.source_path, ["2026-01-01T00:02:30.000Z", "2026-01-01T00:05:00.000Z"], "b")
    J.run_until_done([J.start_features(spark, cfg, TRIGGER)])
    # batch 3: 00:01:30 is older than the watermark -> dropped (its window was already emitted)
    _write_batch(spark, cfg.source_path, ["2026-01-01T00:01:30.000Z"], "c")
    J.run_until_done([J.start_features(spark, cfg, TRIGGER)])
    out = spark.read.parquet(f"{cfg.output_dir}/tumbling_1m")
    got = {r["m"]: r["event_count"] for r in out.select(F.minute("window_start").alias("m"), "event_count").collect()}
    assert got == {0: 1, 1: 1, 2: 2}  # minute 5 is still open: never emitted by an append-mode run


def test_restart_from_checkpoint_adds_no_duplicates(spark):
    cfg, sinks = _setup(spark, "restart")
    _write_batch(spark, cfg.source_path, ["2026-01-01T00:00:10.000Z", "2026-01-01T00:00:20.000Z"], "a")
    risky = dict(weather="rain")
    spark.createDataFrame(
        [(e["driver_id"], json.dumps(e)) for e in [event_row(event_id=f"r{i}", **risky) for i in range(3)]],
        "key string, value string",
    ).write.mode("append").parquet(cfg.source_path)
    J.run_until_done([J.start_alerts(spark, cfg, sinks, TRIGGER)])
    first = J.topic_log(spark, sinks, cfg.alert_topic, "alerts").count()
    J.run_until_done([J.start_alerts(spark, cfg, sinks, TRIGGER)])  # restart, nothing new
    assert J.topic_log(spark, sinks, cfg.alert_topic, "alerts").count() == first == 3
    spark.createDataFrame(
        [("D1", json.dumps(event_row(event_id="r9", weather="snow")))], "key string, value string"
    ).write.mode("append").parquet(cfg.source_path)
    J.run_until_done([J.start_alerts(spark, cfg, sinks, TRIGGER)])
    assert J.topic_log(spark, sinks, cfg.alert_topic, "alerts").count() == 4


def test_update_mode_log_repeats_windows_and_upsert_view_keeps_last(spark):
    cfg, sinks = _setup(spark, "update")
    _write_batch(spark, cfg.source_path, ["2026-01-01T00:00:10.000Z"], "a")
    J.run_until_done([J.start_sliding(spark, cfg, sinks, TRIGGER)])
    _write_batch(spark, cfg.source_path, ["2026-01-01T00:00:40.000Z"], "b")
    J.run_until_done([J.start_sliding(spark, cfg, sinks, TRIGGER)])
    log = J.topic_log(spark, sinks, "sliding_features", "features_sliding_5m")
    assert log.count() == 10  # five windows, each sent in both batches
    schema = "driver_id string, window_start timestamp, event_count long"
    decoded = log.select("batch_id", F.from_json("value", schema).alias("f")).select("batch_id", "f.*")
    latest = J.latest_updates(decoded, ["driver_id", "window_start"])
    assert latest.count() == 5 and {r["event_count"] for r in latest.collect()} == {2}


def test_features_job_runs_its_queries_together(spark):
    cfg, sinks = _setup(spark, "multi")
    _write_batch(spark, cfg.source_path, [f"2026-01-01T00:0{m}:10.000Z" for m in range(4)], "a")
    queries = J.run_features_job(spark, cfg, sinks, TRIGGER)
    assert len(queries) == 2
    J.run_until_done(queries)
    # max event 00:03:10 -> watermark 00:02:40: only windows ending by then are emitted (00:01 and 00:02)
    assert spark.read.parquet(f"{cfg.output_dir}/tumbling_1m").count() == 2


def test_feature_sink_is_partitioned_by_window_date(spark):
    cfg, _ = _setup(spark, "partitioned")
    _write_batch(spark, cfg.source_path, ["2026-01-01T23:59:10.000Z", "2026-01-02T00:01:10.000Z"], "a")
    J.run_until_done([J.start_features(spark, cfg, TRIGGER)])
    out = spark.read.parquet(f"{cfg.output_dir}/tumbling_1m")
    assert "window_date" in out.columns
    assert [str(r["window_date"]) for r in out.collect()] == ["2026-01-01"]
    pruned = out.filter(F.col("window_date") == F.lit("2026-01-01").cast("date"))
    assert "PartitionFilters: [isnotnull(window_date" in pruned._jdf.queryExecution().executedPlan().toString()


def test_stateless_fanout_equals_separate_queries(spark):
    from roadlens.operators import events as E

    cfg, sinks = _setup(spark, "fanout")
    rows = [
        event_row(event_id="a", weather="rain"),
        event_row(event_id="b", braking_ms2=-5.5, event_time="2026-01-01T00:00:01.000Z"),
        event_row(event_id="c", event_time="2026-01-01T00:00:02.000Z"),
    ]
    spark.createDataFrame([(r["driver_id"], json.dumps(r)) for r in rows], "key string, value string").write.parquet(
        cfg.source_path
    )
    J.run_until_done(J.run_combined_job(spark, cfg, sinks, TRIGGER))
    alerts = J.topic_log(spark, sinks, cfg.alert_topic, "alerts")
    decisions = J.topic_log(spark, sinks, cfg.decision_topic, "event_interventions")
    assert sorted(json.loads(r["value"])["event_id"] for r in alerts.collect()) == ["a", "b"]
    assert [json.loads(r["value"])["decision_type"] for r in decisions.collect()] == ["CHECK_DRIVER_STATUS"]


def test_preview_prints_every_row(spark, capsys):
    from roadlens.operators import events as E

    cfg, _ = _setup(spark, "console")
    _write_batch(spark, cfg.source_path, ["2026-01-01T00:00:10.000Z"], "a")
    q = J.preview(E.event_preview(J.flagged_stream(spark, cfg)), "append", TRIGGER)
    J.run_until_done([q])
    assert [json.loads(line)["event_id"] for line in capsys.readouterr().out.splitlines() if line.startswith("{")] == ["a0"]


def test_window_state_lives_in_rocksdb(spark):
    cfg, sinks = _setup(spark, "rocksdb")
    _write_batch(spark, cfg.source_path, [f"2026-01-01T00:0{m}:10.000Z" for m in range(4)], "a")
    queries = J.run_decisions_job(spark, cfg, sinks, TRIGGER)
    J.run_until_done(queries)
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert any("rocksdb" in k.lower() for q in queries for s in q.lastProgress["stateOperators"] for k in s["customMetrics"])


def test_rate_limit_cuts_a_backlog_into_batches(spark):
    from dataclasses import replace

    cfg, sinks = _setup(spark, "rate")
    for i in range(3):
        _write_batch(spark, cfg.source_path, ["2026-01-01T00:00:10.000Z"], f"b{i}")
    files = len([f for f in spark.read.parquet(cfg.source_path).inputFiles()])
    q = J.start_event_decisions(spark, replace(cfg, max_per_trigger=1), sinks, TRIGGER)
    J.run_until_done([q])
    assert q.lastProgress["batchId"] >= files - 1


def test_compaction_keeps_rows_and_leaves_few_files(spark):
    cfg, _ = _setup(spark, "compact")
    for i in range(3):
        _write_batch(spark, cfg.source_path, [f"2026-01-01T00:{10 * i + m}:10.000Z" for m in range(5)], f"c{i}")
        J.run_until_done([J.start_features(spark, cfg, TRIGGER)])
    path, into = f"{cfg.output_dir}/tumbling_1m", f"{cfg.output_dir}/compact"
    J.compact_features(spark, path, into)
    before, after = spark.read.parquet(path), spark.read.parquet(into)
    assert len(after.inputFiles()) == 1 <= len(before.inputFiles())
    assert before.exceptAll(after.select(before.columns)).count() == 0 and before.count() == after.count()


def test_decisions_can_be_followed(spark, capsys):
    from roadlens import cli
    from roadlens.sources import io as IO

    path = scratch_path(spark, "follow")
    rows = [("D1", json.dumps({"driver_id": f"D{i}", "decision_type": "SEND_SAFETY_NUDGE"})) for i in range(60)]
    spark.createDataFrame(rows, "key string, value string").write.parquet(path)
    for mode in ("--available-now", "--from-beginning"):
        cli.main(["consume", "--source-path", path, mode])
        seen = [json.loads(line)["driver_id"] for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
        assert sorted(seen) == sorted(f"D{i}" for i in range(60))
    assert IO.read_decisions_stream(spark, JobConfig(), path).isStreaming
    options = IO.decision_source_options(JobConfig(), "latest")
    assert options["startingOffsets"] == "latest" and options["subscribe"] == "driver_interventions"


def test_read_decisions_keeps_null_keys_and_decodes_both_payloads(spark):
    from roadlens.sources import io as IO

    path = scratch_path(spark, "decisions-read")
    rows = [
        (None, json.dumps({"decision_source": "event", "driver_id": "D1", "event_id": "E1", "decision_type": "CHECK_DRIVER_STATUS"})),
        ("D2", json.dumps({"decision_source": "sliding_window_5m", "driver_id": "D2", "window_start": "2026-01-01T00:05:00.000Z",
                           "event_count": 12, "decision_type": "ESCALATE_HIGH_RISK_REVIEW"})),
    ]
    spark.createDataFrame(rows, "key string, value string").write.parquet(path)
    got = {r["driver_id"]: r for r in IO.read_decisions(spark, JobConfig(), path=path).collect()}
    assert got["D1"]["key"] is None and got["D1"]["event_id"] == "E1"
    assert got["D2"]["event_count"] == 12 and got["D2"]["window_start"] is not None


def test_latest_updates_of_fixed_width_are_hashed_and_keep_nulls(spark):
    rows = [("A", 1, 0, 5, 1.5), ("A", 1, 2, None, 2.5), ("A", 1, 1, 7, None), (None, 1, 1, 3, None), ("A", None, 4, 4, 4.0)]
    log = spark.createDataFrame(rows, "k string, w long, batch_id int, n long, x double")
    latest = J.latest_updates(log, ["k", "w"])
    assert sorted(map(tuple, latest.collect()), key=repr) == sorted([("A", 1, 2, None, 2.5), (None, 1, 1, 3, None), ("A", None, 4, 4, 4.0)], key=repr)
    assert "SortAggregate" not in latest._jdf.queryExecution().executedPlan().toString()
    text = J.latest_updates(log.withColumn("t", F.concat("k", F.col("batch_id").cast("string"))), ["k", "w"])  # text: one struct
    assert {r.t for r in text.collect()} == {"A2", "A4", None}
