"""Command-line jobs (``spark-submit -m``-style entry points) over the library.

    python -m roadlens.cli features   [--bootstrap-server ... --raw-topic ... --output-dir ... --checkpoint-dir ...]
    python -m roadlens.cli decisions  [--decision-topic ... --show-console]
    python -m roadlens.cli streams    (both jobs; stateless outputs share one read of the topic)
    python -m roadlens.cli train      --features-path PATH --output-dir DIR --model-path PATH [--model offset|rate]
    python -m roadlens.cli score      --features-path PATH --model-path PATH --premium-history-path PATH
                                      [--base-premium 1000 --premium-change-cap 0.10 --publish-kafka --topic ...]
    python -m roadlens.cli premium    --premium-history-path PATH --driver-id D001
    python -m roadlens.cli rolling    --events-path PATH --output PATH [--window-events 12 --every 10]
    python -m roadlens.cli consume    --decision-topic ... [--from-beginning | --available-now]
    python -m roadlens.cli compact    --features-path PATH --into PATH [--files-per-date 1]

Streaming jobs block until any of their queries ends.  Batch jobs use the
session's ``spark.checkpoint.dir`` for intermediate tables.  Relative paths
resolve against the session's default file system.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from . import config as C
from .config import JobConfig


def _session(app: str) -> SparkSession:
    spark = SparkSession.builder.appName(app).getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _cfg(a: argparse.Namespace) -> JobConfig:
    kw = {}
    for name in ("bootstrap_servers", "raw_topic", "alert_topic", "feature_topic", "decision_topic", "output_dir",
                 "checkpoint_dir", "premium_topic", "source_format", "source_path"):
        if getattr(a, name, None) is not None:
            kw[name] = getattr(a, name)
    kw["write_feature_topic"] = bool(getattr(a, "write_feature_topic", False))
    kw["show_console"] = bool(getattr(a, "show_console", False))
    return JobConfig(**kw)


def _sinks(a: argparse.Namespace):
    from .streaming import jobs as J

    return J.StreamSinks("parquet", a.topic_root) if getattr(a, "topic_root", None) else J.StreamSinks("kafka")


def _stream_args(p: argparse.ArgumentParser) -> None:
    """Options shared by the streaming commands: a message folder instead of a broker, and a finite run."""
    p.add_argument("--source-format", default=None, help="kafka (default), parquet or json: a folder of key/value messages")
    p.add_argument("--source-path", default=None)
    p.add_argument("--topic-root", default=None, help="write topics as folders under this path instead of Kafka")
    p.add_argument("--available-now", action="store_true", help="process what is available, then stop")


def _run_streams(spark, queries, a) -> None:
    from .streaming import jobs as J

    if getattr(a, "available_now", False):
        J.run_until_done(queries)
    else:
        J.await_any(spark)


def _trigger(a):
    return {"availableNow": True} if getattr(a, "available_now", False) else None


def cmd_features(a):
    from .streaming import jobs as J

    spark = _session("roadlens-features")
    _run_streams(spark, J.run_features_job(spark, _cfg(a), _sinks(a), _trigger(a)), a)


def cmd_decisions(a):
    from .streaming import jobs as J

    spark = _session("roadlens-decisions")
    _run_streams(spark, J.run_decisions_job(spark, _cfg(a), _sinks(a), _trigger(a)), a)


def cmd_streams(a):
    from .streaming import jobs as J

    spark = _session("roadlens-streams")
    _run_streams(spark, J.run_combined_job(spark, _cfg(a), _sinks(a), _trigger(a)), a)


def cmd_train(a):
    from .operators import model as M
    from .operators import pricing as P
    from .session import materialize
    from .sources import io as IO

    spark = _session("roadlens-train")
    # the fit (once per iteration), the predictions and the outputs all read the labelled table: write it once
    df = materialize(P.impute_claims(P.prepare_features(IO.load_features(spark, a.features_path))), "training")
    train, test = P.split(df)
    fit = M.fit_glm(train, a.model, written=True)
    pred = M.predict_with(fit, test).select("driver_id", "exposure_km", "claim_count", "predicted_claim_count", "predicted_frequency")
    metrics = materialize(M.evaluate(pred), "metrics")
    summary = M.summary_text(fit)
    IO.write_outputs(spark, a.output_dir, df, M.coefficients(spark, fit), pred, metrics, summary)
    M.save_model(fit, a.model_path)
    print(summary)
    metrics.show(truncate=False)


def cmd_score(a):
    from .operators import model as M
    from .operators import pricing as P
    from .operators import reports as R
    from .session import materialize
    from .sources import io as IO

    spark = _session("roadlens-score")
    fit = M.load_model(a.model_path)
    history = IO.load_history(spark, a.premium_history_path)
    run = P.premium_run(
        IO.load_features(spark, a.features_path), fit.coefficient_pairs(), history, a.base_premium, a.premium_change_cap
    )
    # The run reads the history it is about to extend: write it first (shared folder).
    run = materialize(run, "premium_run")
    IO.append_history(run, a.premium_history_path)
    R.top_premiums(run, 20).show(20, truncate=False)
    if a.publish_kafka:
        IO.publish_updates(run, JobConfig(bootstrap_servers=a.bootstrap_server, premium_topic=a.topic))


def cmd_premium(a):
    from .operators import pricing as P
    from .sources import io as IO

    spark = _session("roadlens-premium")
    history = IO.load_history(spark, a.premium_history_path)
    if history is None:
        print(f"premium history not found: {a.premium_history_path}", file=sys.stderr)
        sys.exit(2)
    row = P.latest_premium(history, a.driver_id).first()
    if row is None:
        print(f"No premium for driver {a.driver_id}", file=sys.stderr)
        sys.exit(1)
    print(row.asDict())


def cmd_rolling(a):
    from .operators import events as E
    from .operators import rolling as RL
    from .sources import io as IO

    spark = _session("roadlens-rolling")
    events = spark.read.parquet(a.events_path)
    if "event_time_ts" not in events.columns:
        events = E.normalise_event_time(events)
    if a.sequence_column not in events.columns:  # arrival order is not stored: time order, then event id
        events = RL.with_sequence(events, "event_time_ts", "event_id", name=a.sequence_column)
    flagged = E.flag_events(events, with_incident=True)
    IO.write_decisions(RL.demo_decisions(flagged, a.window_events, a.every, seq=a.sequence_column), a.output)


def cmd_consume(a):
    """Print decisions: all there are (``--from-beginning``), or those that arrive from now on."""
    from .sources import io as IO
    from .streaming import jobs as J

    spark = _session("roadlens-consume")
    cfg = JobConfig(bootstrap_servers=a.bootstrap_server, decision_topic=a.decision_topic)
    if a.from_beginning:
        J.print_rows(IO.read_decisions(spark, cfg, a.source_path), 0)
    else:
        _run_streams(spark, [J.preview(IO.read_decisions_stream(spark, cfg, a.source_path), "append", _trigger(a))], a)


def cmd_compact(a):
    from .streaming import jobs as J

    J.compact_features(_session("roadlens-compact"), a.features_path, a.into, a.files_per_date)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="roadlens")
    sub = p.add_subparsers(dest="cmd", required=True)

    f = sub.add_parser("features")
    f.add_argument("--bootstrap-server", dest="bootstrap_servers", default="broker:9092")
    f.add_argument("--raw-topic", default=C.RAW_TOPIC)
    f.add_argument("--alert-topic", default=C.ALERT_TOPIC)
    f.add_argument("--feature-topic", default=C.FEATURE_TOPIC)
    f.add_argument("--output-dir", default="data/historical_features")
    f.add_argument("--checkpoint-dir", default="data/checkpoints")
    f.add_argument("--write-feature-topic", action="store_true")
    f.add_argument("--show-console", action="store_true")
    _stream_args(f)
    f.set_defaults(fn=cmd_features)

    d = sub.add_parser("decisions")
    d.add_argument("--bootstrap-server", dest="bootstrap_servers", default="broker:9092")
    d.add_argument("--raw-topic", default=C.RAW_TOPIC)
    d.add_argument("--decision-topic", default=C.DECISION_TOPIC)
    d.add_argument("--checkpoint-dir", default="data/checkpoints/realtime_decisions")
    d.add_argument("--show-console", action="store_true")
    _stream_args(d)
    d.set_defaults(fn=cmd_decisions)

    b = sub.add_parser("streams", help="alerts, event decisions (one shared read), features and window decisions")
    b.add_argument("--bootstrap-server", dest="bootstrap_servers", default="broker:9092")
    b.add_argument("--raw-topic", default=C.RAW_TOPIC)
    b.add_argument("--alert-topic", default=C.ALERT_TOPIC)
    b.add_argument("--decision-topic", default=C.DECISION_TOPIC)
    b.add_argument("--output-dir", default="data/historical_features")
    b.add_argument("--checkpoint-dir", default="data/checkpoints")
    _stream_args(b)
    b.set_defaults(fn=cmd_streams)

    t = sub.add_parser("train")
    t.add_argument("--features-path", default="data/historical_features/tumbling_1m")
    t.add_argument("--output-dir", default="data/model_outputs")
    t.add_argument("--model-path", default="models/glm_model")
    t.add_argument("--model", choices=("offset", "rate"), default="offset")
    t.set_defaults(fn=cmd_train)

    s = sub.add_parser("score")
    s.add_argument("--features-path", default="data/historical_features/tumbling_1m")
    s.add_argument("--model-path", default="models/glm_model")
    s.add_argument("--premium-history-path", default="data/premium_history/premium_history")
    s.add_argument("--base-premium", type=float, default=1000.0)
    s.add_argument("--premium-change-cap", type=float, default=0.10)
    s.add_argument("--publish-kafka", action="store_true")
    s.add_argument("--bootstrap-server", default="broker:9092")
    s.add_argument("--topic", default=C.PREMIUM_TOPIC)
    s.set_defaults(fn=cmd_score)

    q = sub.add_parser("premium")
    q.add_argument("--premium-history-path", default="data/premium_history/premium_history")
    q.add_argument("--driver-id", required=True)
    q.set_defaults(fn=cmd_premium)

    r = sub.add_parser("rolling")
    r.add_argument("--events-path", required=True)
    r.add_argument("--output", default="data/rolling_decisions")
    r.add_argument("--window-events", type=int, default=12)
    r.add_argument("--every", type=int, default=10)
    r.add_argument("--sequence-column", default="event_no")
    r.set_defaults(fn=cmd_rolling)

    c = sub.add_parser("consume")
    c.add_argument("--bootstrap-server", default="broker:9092")
    c.add_argument("--decision-topic", default=C.DECISION_TOPIC)
    c.add_argument("--from-beginning", action="store_true")
    c.add_argument("--source-path", default=None, help="a folder of key/value messages instead of the broker")
    c.add_argument("--available-now", action="store_true", help="process what is available, then stop")
    c.set_defaults(fn=cmd_consume)

    k = sub.add_parser("compact", help="rewrite a feature folder with few files per date")
    k.add_argument("--features-path", default="data/historical_features/tumbling_1m")
    k.add_argument("--into", required=True)
    k.add_argument("--files-per-date", type=int, default=1)
    k.set_defaults(fn=cmd_compact)

    a = p.parse_args(argv)
    a.fn(a)


if __name__ == "__main__":
    main()
