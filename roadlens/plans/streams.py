"""Registered queries for streaming jobs and for sources / sinks.

Each streaming query writes the projected messages into a folder of the
shared location (``spark.checkpoint.dir``), runs the Structured Streaming job
over it with an ``availableNow`` trigger (one or two micro-batches, the
second one added after the first has been processed, as on a restart) and
reads what the sink wrote back as a table.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import JobConfig
from ..operators import events as E
from ..operators import model as M
from ..operators import pricing as P
from ..operators import rolling as RL
from ..operators import windows as W
from ..schemas import DECISION_SCHEMA, EVENT_COLUMNS, PREMIUM_HISTORY_SCHEMA
from ..session import materialize, release, scratch_path
from ..sources import io as IO
from ..sources import premium_snapshot as PS
from ..sources import rollup_store as RS
from ..sources import topic_log as T
from .fixture import TARGET_EPOCH_MS, raw_events
from ..streaming import cooldown as CD
from ..streaming import count_windows as CW
from ..streaming import jobs as J
from ..streaming import late as LT
from . import inputs as I
from .catalog import (
    alert_output,
    event_decision_output,
    feature_output,
    history_output,
    moment_output,
    register,
    rollup_output,
    window_decision_output,
)

# fixed value: the two-batch runs split the fixture's event time at minute 108 (the middle of its 216 minutes)
SPLIT_MS = TARGET_EPOCH_MS + 108 * 60_000
TRIGGER = {"availableNow": True}


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = raw_events(spark, sf_dir)
    return ev.select(
        F.col("driver_id").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in EVENT_COLUMNS])).alias("value"),
        "event_ms",
        "event_no",
    )


def _run(spark: SparkSession, sf_dir: str, name: str, start, batches: int = 1):
    """Write the messages in ``batches`` time slices; after each slice, run the started queries to completion."""
    root = scratch_path(spark, name)
    src = f"{root}/input"
    cfg = J.with_paths(JobConfig(), root, src)
    sinks = J.StreamSinks("parquet", f"{root}/topics")
    msgs = _messages(spark, sf_dir)
    slices = [msgs] if batches == 1 else [msgs.filter(F.col("event_ms") < SPLIT_MS), msgs.filter(F.col("event_ms") >= SPLIT_MS)]
    for part in slices:
        part.select("key", "value").write.mode("append").parquet(src)
        J.run_until_done(start(spark, cfg, sinks))
    release(spark, src)  # the results are read from what the sinks wrote
    release(spark, cfg.checkpoint_dir)
    return cfg, sinks


def _topic(spark: SparkSession, sinks: J.StreamSinks, topic: str, name: str) -> DataFrame:
    return J.topic_log(spark, sinks, topic, name)


# --- 2.8 streaming ----------------------------------------------------------------------------------


@register("source_events_stream")
def q_source_events_stream(spark, sf_dir):
    def start(spark, cfg, sinks):
        flagged = J.flagged_stream(spark, cfg)
        out = flagged.select("event_id", "driver_id", F.unix_millis("event_time_ts").alias("event_time_ts"), "risk_score_event")
        q = (
            out.writeStream.format("parquet")
            .option("path", f"{cfg.output_dir}/events")
            .option("checkpointLocation", f"{cfg.checkpoint_dir}/events")
            .trigger(**TRIGGER)
            .start()
        )
        return [q]

    cfg, _ = _run(spark, sf_dir, "source_events_stream", start)
    return spark.read.parquet(f"{cfg.output_dir}/events")


def _alert_schema(spark, sf_dir):
    return E.build_alert_rows(I.flagged_events(spark, sf_dir, with_incident=False)).schema


@register("stream_alerts")
def q_stream_alerts(spark, sf_dir):
    cfg, sinks = _run(spark, sf_dir, "stream_alerts", lambda s, c, k: [J.start_alerts(s, c, k, TRIGGER)])
    log = _topic(spark, sinks, cfg.alert_topic, "alerts")
    decoded = log.select(F.from_json("value", _alert_schema(spark, sf_dir)).alias("a")).select("a.*")
    return alert_output(decoded)


@register("sink_features_parquet")
def q_sink_features_parquet(spark, sf_dir):
    cfg, _ = _run(spark, sf_dir, "sink_features_parquet", lambda s, c, k: [J.start_features(s, c, TRIGGER)])
    return feature_output(IO.load_features(spark, f"{cfg.output_dir}/tumbling_1m"))


@register("stream_tumbling_append")
def q_stream_tumbling(spark, sf_dir):
    cfg, _ = _run(spark, sf_dir, "stream_tumbling_append", lambda s, c, k: [J.start_features(s, c, TRIGGER)], batches=2)
    return feature_output(IO.load_features(spark, f"{cfg.output_dir}/tumbling_1m"))


def _sliding_schema(spark, sf_dir):
    return W.sliding_features(I.flagged_events(spark, sf_dir, with_incident=False)).schema


@register("stream_sliding_update")
def q_stream_sliding(spark, sf_dir):
    cfg, sinks = _run(spark, sf_dir, "stream_sliding_update", lambda s, c, k: [J.start_sliding(s, c, k, TRIGGER)], batches=2)
    log = _topic(spark, sinks, "sliding_features", "features_sliding_5m")
    decoded = log.select("batch_id", F.from_json("value", _sliding_schema(spark, sf_dir)).alias("f")).select("batch_id", "f.*")
    return feature_output(J.latest_updates(decoded, ["driver_id", "window_start"]))


def _decision_log(spark, sinks, cfg, name: str) -> DataFrame:
    log = _topic(spark, sinks, cfg.decision_topic, name)
    return log.select(
        "key", F.col("batch_id") if "batch_id" in log.columns else F.lit(None).cast("long").alias("batch_id"),
        F.from_json("value", DECISION_SCHEMA).alias("d"),
    ).select("key", "batch_id", "d.*")


@register("stream_event_decisions")
def q_stream_event_decisions(spark, sf_dir):
    cfg, sinks = _run(spark, sf_dir, "stream_event_decisions", lambda s, c, k: [J.start_event_decisions(s, c, k, TRIGGER)])
    d = _decision_log(spark, sinks, cfg, "event_interventions")
    fields = [f for f in E.EVENT_DECISION_FIELDS]
    return event_decision_output(d.select(*fields).withColumn("risk_score_event", F.col("risk_score_event").cast("int")))


@register("stream_window_decisions")
def q_stream_window_decisions(spark, sf_dir):
    cfg, sinks = _run(spark, sf_dir, "stream_window_decisions", lambda s, c, k: [J.start_window_decisions(s, c, k, TRIGGER)])
    d = J.latest_updates(_decision_log(spark, sinks, cfg, "window_interventions"), ["driver_id", "window_start"])
    return window_decision_output(d.select(*W.WINDOW_DECISION_FIELDS))


def _run_topic(spark: SparkSession, sf_dir: str, name: str, start, before=(), slices=(), starting: str = "earliest") -> JobConfig:
    """Like ``_run`` over a topic folder with offsets: publish ``before``, then run ``start`` once, and again after each of ``slices``."""
    root = scratch_path(spark, name)
    cfg = replace(J.with_paths(JobConfig(), root, f"{root}/topic", T.FORMAT), starting_offsets=starting)
    msgs = _messages(spark, sf_dir)
    for cond in before:
        T.append_messages(msgs.filter(cond), cfg.source_path, "event_ms", "event_no")
    for cond in slices:
        if cond is not None:
            T.append_messages(msgs.filter(cond), cfg.source_path, "event_ms", "event_no")
        J.run_until_done([start(spark, cfg)])
    return cfg


@register("source_topic_offsets")
def q_source_topic_offsets(spark, sf_dir):
    """A stream that starts at the latest offset: half of the messages are there before its first run and are not read;
    the third quarter comes after a first run that found nothing, the last after a restart."""
    late = SPLIT_MS + (SPLIT_MS - TARGET_EPOCH_MS) // 2
    at = F.col("event_ms")

    def start(spark, cfg):
        events = E.parse_events(IO.read_events_stream(spark, cfg, with_offset=True), keep=("offset",))
        out = events.select("offset", "event_id", "driver_id", F.unix_millis("event_time_ts").alias("event_time_ts"))
        writer = out.writeStream.format("parquet").option("path", f"{cfg.output_dir}/events")
        return writer.option("checkpointLocation", f"{cfg.checkpoint_dir}/events").trigger(**TRIGGER).start()

    slices = [None, (at >= SPLIT_MS) & (at < late), at >= late, None]
    cfg = _run_topic(spark, sf_dir, "source_topic_offsets", start, [at < SPLIT_MS], slices, "latest")
    return spark.read.schema("offset long, event_id string, driver_id string, event_time_ts long").parquet(f"{cfg.output_dir}/events")


def _last_events(spark, sf_dir, name: str) -> tuple[DataFrame, DataFrame]:
    """(buffers sent, buffers still open) after two slices, each with a run of its own, and a restart with nothing new."""
    halves = [F.col("event_ms") < SPLIT_MS, F.col("event_ms") >= SPLIT_MS, None]
    cfg = _run_topic(spark, sf_dir, name, lambda s, c: J.start_last_events(s, c, TRIGGER), slices=halves)
    sent = spark.read.parquet(f"{cfg.output_dir}/{J.LAST_EVENTS}")
    return sent, materialize(J.open_buffers(spark, cfg), "open_buffers")


@register("stream_last_n_features")
def q_stream_last_n_features(spark, sf_dir):
    """The count-window features of a stream: the buffers closed so far and, from the query's state, those still open."""
    sent, still = _last_events(spark, sf_dir, "stream_last_n_features")
    closed = sent.filter("status = 'closed'").select(*still.columns, "next_seq")
    both = closed.unionByName(still.withColumn("next_seq", F.lit(None).cast("long")))
    return both.select(
        "driver_id", "event_id", "event_no", "event_count", F.round("km_window", 4).alias("km_driven"),
        "risk_event_count", "risk_score_window", "phone_usage_count", "next_seq",
    )


@register("stream_tick_decisions")
def q_stream_tick_decisions(spark, sf_dir):
    """The tick decisions of a stream, as ranges of the closed buffers, and those taken on buffers open at a tick (``n_ticks`` 0)."""
    sent, _ = _last_events(spark, sf_dir, "stream_tick_decisions")
    ranges = CW.closed_tick_ranges(sent, C.JobConfig.tick_every).drop("decision_ts")
    at_once = CW.open_tick_decisions(sent).drop("decision_ts").withColumnRenamed("tick", "first_tick")
    return ranges.unionByName(at_once.withColumns({"last_tick": F.col("first_tick"), "n_ticks": F.lit(0).cast("long")}))


@register("stream_sliding_table")
def q_stream_sliding_table(spark, sf_dir):
    """The sliding windows' latest state after two slices, merged batch by batch; no log of updates is read."""
    cfg, _ = _run(spark, sf_dir, "stream_sliding_table", lambda s, c, k: [J.start_sliding_table(s, c, TRIGGER)], batches=2)
    return feature_output(J.sliding_table(cfg, _sliding_schema(spark, sf_dir)).read(spark))


@register("stream_decision_table")
def q_stream_decision_table(spark, sf_dir):
    """The decision last sent for every window, merged batch by batch."""
    cfg, _ = _run(spark, sf_dir, "stream_decision_table", lambda s, c, k: [J.start_decision_table(s, c, TRIGGER)])
    schema = W.build_window_decision_rows(W.decision_windows(I.flagged_events(spark, sf_dir))).schema
    return window_decision_output(J.decision_table(cfg, schema).read(spark).select(*W.WINDOW_DECISION_FIELDS))


@register("state_of_open_windows")
def q_state_of_open_windows(spark, sf_dir):
    """The windows in the state of the feature query: after the first half of the messages, and after a restart with nothing new."""
    root = scratch_path(spark, "state_of_open_windows")
    cfg = J.with_paths(JobConfig(), root, f"{root}/input")
    J.use_rocksdb(spark)
    msgs = _messages(spark, sf_dir).filter(F.col("event_ms") < SPLIT_MS)
    msgs.select("key", "value").write.parquet(cfg.source_path)
    found = []
    for when in ("before", "after"):
        J.run_until_done([J.start_features(spark, cfg, TRIGGER)])
        found.append(materialize(J.open_windows(spark, cfg).withColumn("restart", F.lit(when)), "open_windows"))
    both = found[0].unionByName(found[1])
    return both.withColumns({"window_start": F.unix_seconds("window_start"), "window_end": F.unix_seconds("window_end")})


COOLDOWN_S = 120


@register("stream_decision_cooldown")
def q_stream_decision_cooldown(spark, sf_dir):
    """Event decisions with every message published twice: one per event, and one per driver within two minutes."""
    root = scratch_path(spark, "stream_decision_cooldown")
    cfg = J.with_paths(JobConfig(), root, f"{root}/input")
    J.use_rocksdb(spark)
    msgs = _messages(spark, sf_dir)
    fields = ["event_id", "driver_id", "event_time_ts", "decision_type", "priority"]
    for cond in (F.col("event_ms") < SPLIT_MS, F.col("event_ms") >= SPLIT_MS, None):
        if cond is not None:
            part = msgs.filter(cond).select("key", "value")
            part.union(part).write.mode("append").parquet(cfg.source_path)
        events = CD.once_per_event(J.flagged_stream(spark, cfg, with_incident=True), cfg.watermark)
        sent = CD.with_cooldown(E.build_event_decision_rows(events, "stream").select(*fields), COOLDOWN_S)
        writer = sent.writeStream.format("parquet").option("path", f"{root}/sent").option("checkpointLocation", f"{root}/checkpoint")
        J.run_until_done([writer.trigger(**TRIGGER).start()])
    release(spark, cfg.source_path)
    return spark.read.parquet(f"{root}/sent").withColumn("event_time_ts", F.unix_millis("event_time_ts"))


@register("late_rows")
def q_late_rows(spark, sf_dir):
    """The later half of the messages first, then the earlier half: every row is on time or late, and kept."""
    root = scratch_path(spark, "late_rows")
    cfg = J.with_paths(JobConfig(), root, f"{root}/input")
    split = LT.LateSplit(f"{root}/split", 30_000)
    msgs = _messages(spark, sf_dir)
    schema = None
    for cond in (F.col("event_ms") >= SPLIT_MS, F.col("event_ms") < SPLIT_MS, None):
        if cond is not None:
            msgs.filter(cond).select("key", "value").write.mode("append").parquet(cfg.source_path)
        events = J.flagged_stream(spark, cfg).select("event_id", "driver_id", "event_time_ts")
        schema = events.schema
        J.run_until_done([LT.start_late_split(events, split, f"{root}/checkpoint", TRIGGER)])
    parts = [split.read(spark, kind, schema).withColumn("kind", F.lit(kind)) for kind in ("on_time", "late")]
    return parts[0].unionByName(parts[1]).withColumn("event_time_ts", F.unix_millis("event_time_ts"))


# --- 2.1 sources and sinks (batch) ---------------------------------------------------------------------


@register("source_feature_store")
def q_source_feature_store(spark, sf_dir):
    """A CSV feature table, and a Parquet folder with files of three layouts: an older one without three columns, one
    with the columns the other way round, one with a column more."""
    path = scratch_path(spark, "feature_store")
    feats = materialize(feature_output(W.tumbling_features(I.flagged_events(spark, sf_dir, with_incident=False))), "features")
    IO.write_features_csv(feats, f"{path}/tumbling_1m.csv")
    part = F.expr("window_start div 60") % 3
    layouts = (
        feats.filter(part == 0).drop("speeding_ratio", "max_speed", "phone_usage_count"),
        feats.filter(part == 1).select(*reversed(feats.columns)),
        feats.filter(part == 2).withColumn("fleet", F.concat(F.lit("F"), F.substring("driver_id", -1, 1))),
    )
    for layout in layouts:
        layout.write.mode("append").parquet(f"{path}/tumbling_1m")
    csv = IO.load_features(spark, f"{path}/tumbling_1m.csv", feats.schema).withColumns({"fleet": F.lit(None).cast("string"), "read_from": F.lit("csv")})
    return csv.unionByName(IO.load_features(spark, f"{path}/tumbling_1m").withColumn("read_from", F.lit("parquet")))


def _history_path(spark, name: str) -> str:
    return scratch_path(spark, name) + "/premium_history"


@register("source_premium_history")
def q_source_premium_history(spark, sf_dir):
    """A history of two runs and of files older than the present columns, in CSV and in Parquet: read by name."""
    path = _history_path(spark, "source_premium_history")
    assert IO.load_history(spark, path) is None
    first, second = I.premium_runs(spark, sf_dir, 2)
    older = first.select("scored_at", "technical_premium", "driver_id", "technical_premium_previous")
    histories = []
    for kind in ("parquet", "csv"):
        at = f"{path}.{kind}"
        writer = older.write.mode("append").option("header", True)
        writer.csv(at) if kind == "csv" else writer.parquet(at)
        IO.append_history(second, at)
        IO.append_history(first.select(*reversed(first.columns)).withColumn("scored_at", F.lit(I.RUNS[2][2])), at)
        histories.append(history_output(IO.load_history(spark, at)).withColumn("read_from", F.lit(kind)))
    return histories[0].unionByName(histories[1])


@register("sink_premium_history")
def q_sink_premium_history(spark, sf_dir):
    """Three runs, each reading the history the earlier runs appended."""
    path = _history_path(spark, "sink_premium_history")
    rolled = materialize(P.driver_rollup(P.prepare_features(I.pricing_features(spark, sf_dir))), "rollup")
    for base, cap, stamp in I.RUNS:
        history = IO.load_history(spark, path)
        IO.append_history(P.premium_run_of_rollup(rolled, C.COMMITTED_COEFFICIENTS, history, base, cap, scored_at=stamp), path)
    return history_output(IO.load_history(spark, path))


def _snapshot(spark, sf_dir, name: str) -> str:
    """A snapshot into which three runs were merged, one of them twice and one out of order."""
    path = scratch_path(spark, name)
    runs = I.premium_runs(spark, sf_dir)
    for run in (runs[0], runs[2], runs[1], runs[2]):
        PS.merge_run(run, path, buckets=8)
    return path


@register("premium_snapshot")
def q_premium_snapshot(spark, sf_dir):
    """The latest premium of every driver, kept by merging each run."""
    return history_output(PS.read_snapshot(spark, _snapshot(spark, sf_dir, "premium_snapshot")))


@register("premium_lookup")
def q_premium_lookup(spark, sf_dir):
    """One driver's latest premium, read from one bucket of the snapshot."""
    return history_output(PS.lookup(spark, _snapshot(spark, sf_dir, "premium_lookup"), "D0007"))


@register("driver_rollup_incremental")
def q_driver_rollup_incremental(spark, sf_dir):
    """The drivers' roll-up from stored partial sums: topped up after the first half of the windows, and after all."""
    root = scratch_path(spark, "driver_rollup_incremental")
    hour = F.date_format("window_start", "yyyy-MM-dd'T'HH")
    features = materialize(I.pricing_features(spark, sf_dir).withColumn("window_hour", hour), "features")
    first = F.unix_millis("window_start") < SPLIT_MS
    for part in (features.filter(first), features.filter(~first)):
        part.write.mode("append").partitionBy("window_hour").parquet(f"{root}/features")
        RS.top_up(spark, f"{root}/features", f"{root}/rollup", "window_hour")
    return rollup_output(RS.stored_rollup(spark, f"{root}/rollup"))


@register("sink_premium_updates")
def q_sink_premium_updates(spark, sf_dir):
    path = scratch_path(spark, "premium_updates")
    run = I.premium_runs(spark, sf_dir)[-1]
    IO.publish_updates(run, JobConfig(), path=path)
    msgs = spark.read.parquet(path)
    decoded = msgs.select("key", F.from_json("value", PREMIUM_HISTORY_SCHEMA).alias("p")).select("key", "p.*")
    return _history_with_key(decoded)


def _history_with_key(decoded: DataFrame) -> DataFrame:
    """The message key next to the decoded 17 history columns."""
    return history_output(decoded, "key")


DEMO_OUTPUT = (
    "at_event", "last_tick", "n_ticks", "decision_source", "driver_id", "event_id", "decision_type", "priority", "recommended_action",
    "customer_message", "active_rules", "risk_score_event", "event_count", "km_driven", "risk_event_count",
    "risk_score_window", "risk_intensity", "phone_usage_count",
)


@register("sink_decisions_jsonl")
def q_sink_decisions_jsonl(spark, sf_dir):
    """The count-window policy's decisions (per event, and per state with its range of ticks) as JSON lines, read back."""
    path = scratch_path(spark, "decisions_jsonl")
    decisions = RL.demo_decisions(I.flagged_events(spark, sf_dir), C.JobConfig.window_events, C.JobConfig.tick_every)
    IO.write_decisions(decisions, path)
    back = spark.read.schema(decisions.schema).json(path)
    rules = F.when(F.col("active_rules").isNull(), F.lit(None).cast("string")).otherwise(F.concat_ws("|", "active_rules"))
    return back.withColumn("active_rules", rules).select(*DEMO_OUTPUT)


@register("source_decisions")
def q_source_decisions(spark, sf_dir):
    path = scratch_path(spark, "decision_topic")
    flagged = I.flagged_events(spark, sf_dir)
    E.build_event_decisions(flagged).write.mode("append").parquet(path)
    W.build_window_decisions(W.decision_windows(flagged)).write.mode("append").parquet(path)
    d = IO.read_decisions(spark, JobConfig(), path=path)
    return d.select(
        "key",
        "decision_source",
        "driver_id",
        F.coalesce(F.col("event_id"), F.lit("")).alias("event_id"),
        F.coalesce(F.unix_seconds("window_start"), F.lit(-1).cast("long")).alias("window_start"),
        "decision_type",
        "priority",
    )


#: Of the training rows, the columns that are compared after they were written.
TRAINING_COLUMNS = ("exposure_km", "event_count", "claim_count", "expected_claim_rate", *C.FEATURE_COLUMNS)


@register("sink_model_outputs")
def q_sink_model_outputs(spark, sf_dir):
    """All five outputs written, then read back: per output and column the values counted, and summed with a weight
    that differs from row to row; where only the fit knows a value, the difference from the value before it was written."""
    out = scratch_path(spark, "model_outputs")
    train, test = I.train_test(spark, sf_dir, materialized=True)
    fit = M.fit_glm(train, "rate", written=True)
    pred = M.predict_with(fit, test).select(
        "driver_id", "exposure_km", "claim_count", "predicted_claim_count", "predicted_frequency"
    )
    metrics = M.evaluate(pred)
    IO.write_outputs(spark, out, train, M.coefficients(spark, fit), pred, metrics, M.summary_text(fit))

    def lines(df: DataFrame, output: str, totals: dict) -> DataFrame:
        """(output, column, n_values, total) of each column."""
        sums = df.agg(*[F.struct(F.count(v).alias("n"), F.round(F.sum(w * v), 4).alias("t")).alias(c) for c, (v, w) in totals.items()])
        rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}.n").alias("n_values"), F.col(f"{c}.t").alias("total")) for c in totals]
        return sums.select(F.inline(F.array(*rows))).select(F.lit(output).alias("output"), "column_name", "n_values", "total")

    one = F.lit(1.0)
    table = lambda name: IO.load_features(spark, f"{out}/{name}.csv")
    driver = F.substring("driver_id", 2, 32).cast("long")
    weight = (driver * 31 + F.col("minute").cast("long") * 17) % 101 + 1
    kept = table("training_dataset")
    found = lines(kept, "training_dataset", {c: (F.col(c).cast("double"), weight) for c in TRAINING_COLUMNS})
    by_driver = {c: (F.col(c).cast("double"), driver % 101) for c in pred.columns[1:]}
    before = lines(pred, "glm_test_predictions", by_driver).withColumnRenamed("total", "was").select("column_name", "was")
    read = lines(table("glm_test_predictions"), "glm_test_predictions", by_driver).join(before, "column_name")
    fitted = F.col("column_name").startswith("predicted")
    read = read.select("output", "column_name", "n_values", F.when(fitted, F.round(F.col("total") - F.col("was"), 3) + 0.0).otherwise(F.col("total")).alias("total"))
    gap = F.col("exp_coef").cast("double") - F.exp(F.col("coef").cast("double"))
    made = metrics.first()
    stored = {c: (F.col(c) - F.lit(made[c]), one) for c in ("mae", "rmse", "mean_predicted_claim_count")}
    parts = [
        read,
        lines(table("glm_coefficients"), "glm_coefficients", {"exp_coef": (gap, one)}),
        lines(spark.read.json(f"{out}/glm_metrics"), "glm_metrics", {"mean_claim_count": (F.col("mean_claim_count"), one), **stored}),
        lines(spark.read.text(f"{out}/glm_summary").filter("value LIKE '%=%'"), "glm_summary", {"value": (F.lit(0.0), one)}),
    ]
    for part in parts:
        found = found.unionByName(part)
    return found


@register("model_store")
def q_model_store(spark, sf_dir):
    """The rate model saved and loaded again; its moments over the training part (see ``moment_output``)."""
    train, _ = I.train_test(spark, sf_dir, materialized=True)
    path = scratch_path(spark, "model_store")
    M.save_model(M.fit_glm(train, "rate", written=True), path)
    loaded = M.load_model(path)
    return moment_output(M.moments(loaded.coefficient_pairs(), train, C.RATE_MODEL_ALPHA))


@register("sink_topic_stream")
def q_sink_topic_stream(spark, sf_dir):
    """The optional feature topic: closed one-minute windows as key/value messages, decoded again."""
    cfg, sinks = _run(spark, sf_dir, "sink_topic_stream", lambda s, c, k: [J.start_feature_topic(s, c, k, TRIGGER)])
    log = _topic(spark, sinks, cfg.feature_topic, "features_kafka")
    schema = W.tumbling_features(I.flagged_events(spark, sf_dir, with_incident=False)).schema
    decoded = log.select("key", F.from_json("value", schema).alias("f")).select("key", "f.*")
    return feature_output(decoded, "key")


def _run_slices(spark, sf_dir, name, start, slices):
    """Like ``_run`` but with the given message slices, each followed by a run of the started queries."""
    root = scratch_path(spark, name)
    cfg = J.with_paths(JobConfig(), root, f"{root}/input")
    sinks = J.StreamSinks("parquet", f"{root}/topics")
    msgs = _messages(spark, sf_dir)
    for cond in slices:
        if cond is not None:
            msgs.filter(cond).select("key", "value").write.mode("append").parquet(cfg.source_path)
        J.run_until_done(start(spark, cfg, sinks))
    release(spark, cfg.source_path)
    release(spark, cfg.checkpoint_dir)
    return cfg, sinks


@register("stream_fanout")
def q_stream_fanout(spark, sf_dir):
    """One read of the messages feeding alerts and event decisions; both outputs in one table."""
    cfg, sinks = _run(spark, sf_dir, "stream_fanout", lambda s, c, k: [J.start_stateless_fanout(s, c, k, TRIGGER)], batches=2)
    log = _topic(spark, sinks, cfg.alert_topic, "alerts")
    alerts = alert_output(log.select(F.from_json("value", _alert_schema(spark, sf_dir)).alias("a")).select("a.*"))
    decisions = _decision_log(spark, sinks, cfg, "event_interventions")
    return alerts.select(
        F.lit("alert").alias("output"), "event_id", "driver_id", "event_time_ts", "active_rules", F.lit(None).cast("string").alias("decision_type")
    ).unionByName(
        event_decision_output(decisions.select(*E.EVENT_DECISION_FIELDS)).select(
            F.lit("decision").alias("output"), "event_id", "driver_id", "event_time_ts", "active_rules", "decision_type"
        )
    )


@register("late_data")
def q_late_data(spark, sf_dir):
    """Later half of the stream first, earlier half second: the earlier rows are behind the watermark and dropped."""
    late_first = [F.col("event_ms") >= SPLIT_MS, F.col("event_ms") < SPLIT_MS]
    cfg, _ = _run_slices(spark, sf_dir, "late_data", lambda s, c, k: [J.start_features(s, c, TRIGGER)], late_first)
    return feature_output(IO.load_features(spark, f"{cfg.output_dir}/tumbling_1m"))


@register("checkpoint_restart")
def q_checkpoint_restart(spark, sf_dir):
    """Alerts over the first half, a restart with nothing new, then the second half: each alert once."""
    slices = [F.col("event_ms") < SPLIT_MS, None, F.col("event_ms") >= SPLIT_MS]
    cfg, sinks = _run_slices(spark, sf_dir, "checkpoint_restart", lambda s, c, k: [J.start_alerts(s, c, k, TRIGGER)], slices)
    log = _topic(spark, sinks, cfg.alert_topic, "alerts")
    decoded = log.select(F.from_json("value", _alert_schema(spark, sf_dir)).alias("a")).select("a.*")
    return alert_output(decoded)


@register("multi_query")
def q_multi_query(spark, sf_dir):
    """The features job's queries run together in one session; per driver: alerts sent and windows stored."""
    cfg, sinks = _run(spark, sf_dir, "multi_query", lambda s, c, k: J.run_features_job(s, c, k, TRIGGER))
    alerts = _topic(spark, sinks, cfg.alert_topic, "alerts").groupBy(F.col("key").alias("driver_id")).agg(
        F.count(F.lit(1)).alias("alert_count")
    )
    windows = IO.load_features(spark, f"{cfg.output_dir}/tumbling_1m").groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("window_count"), F.sum("event_count").alias("windowed_events")
    )
    return alerts.join(windows, "driver_id", "full_outer").select(
        "driver_id",
        F.coalesce("alert_count", F.lit(0).cast("long")).alias("alert_count"),
        F.coalesce("window_count", F.lit(0).cast("long")).alias("window_count"),
        F.coalesce("windowed_events", F.lit(0).cast("long")).alias("windowed_events"),
    )
