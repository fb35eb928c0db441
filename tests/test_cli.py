"""Command-line jobs end to end on derived features: train, score twice (history grows), latest premium."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF001
from roadlens import cli
from roadlens.plans import inputs as I
from roadlens.session import scratch_path
from roadlens.sources import io as IO


def test_train_score_lookup(spark, capsys):
    root = scratch_path(spark, "cli")
    feats = I.pricing_features(spark, SF001).drop("d", "minute")
    feats.write.parquet(f"{root}/features")
    cli.main(["train", "--features-path", f"{root}/features", "--output-dir", f"{root}/outputs",
              "--model-path", f"{root}/model", "--model", "rate"])
    coef = spark.read.option("header", True).csv(f"{root}/outputs/glm_coefficients.csv")
    assert coef.count() == 7
    for _ in range(2):
        cli.main(["score", "--features-path", f"{root}/features", "--model-path", f"{root}/model",
                  "--premium-history-path", f"{root}/history"])
    history = IO.load_history(spark, f"{root}/history")
    drivers = feats.select("driver_id").distinct().count()
    assert history.count() == 2 * drivers
    # the second run starts from the first run's premiums, so it moves less than the cap allows
    assert history.filter(F.abs(F.col("technical_premium") / F.col("technical_premium_previous") - 1) > 0.1 + 1e-5).count() == 0
    capsys.readouterr()
    cli.main(["premium", "--premium-history-path", f"{root}/history", "--driver-id", "D0001"])
    assert "D0001" in capsys.readouterr().out


def test_streams_command_replays_a_message_folder(spark):
    import json

    from conftest import event_row

    root = scratch_path(spark, "cli-streams")
    rows = [event_row(event_id=f"e{i}", weather="rain" if i % 2 else "clear", event_time=f"2026-01-01T00:0{i}:10.000Z")
            for i in range(4)]
    spark.createDataFrame([(r["driver_id"], json.dumps(r)) for r in rows], "key string, value string").write.parquet(
        f"{root}/messages"
    )
    cli.main(["streams", "--source-format", "parquet", "--source-path", f"{root}/messages", "--topic-root",
              f"{root}/topics", "--output-dir", f"{root}/features", "--checkpoint-dir", f"{root}/checkpoints",
              "--available-now"])
    assert spark.read.parquet(f"{root}/topics/telematics_alerts/alerts").count() == 2
    # watermark = 00:03:10 - 30 s: the windows ending at 00:01 and 00:02 are closed and written
    assert spark.read.parquet(f"{root}/features/tumbling_1m").count() == 2


def test_rolling_writes_both_kinds_of_decisions_and_derives_the_sequence(spark):
    from roadlens.plans.fixture import raw_events

    root = scratch_path(spark, "cli-rolling")
    raw_events(spark, SF001).drop("event_no", "event_ms", "event_time_ts").write.parquet(f"{root}/events")
    cli.main(["rolling", "--events-path", f"{root}/events", "--output", f"{root}/out"])
    kinds = {r["decision_source"]: r["count"] for r in spark.read.json(f"{root}/out").groupBy("decision_source").count().collect()}
    assert len(kinds) == 2 and min(kinds.values()) > 0
