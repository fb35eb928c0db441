"""Structured Streaming jobs: features (alerts, tumbling parquet, sliding preview) and decisions.

The operators are the batch ones: each query is ``source -> parse -> flags ->
operator -> sink`` with a 30 s watermark on ``event_time_ts``.  Every query
has its own checkpoint folder, so a restart resumes from its offsets and
state; previews keep none.  Window state lives in RocksDB (on disk, with
changelog checkpoints), so it is not bound by executor heap; a rate limit on
the source (``cfg.max_per_trigger``) bounds a micro-batch after a long stop.

Sinks: ``cfg.sink_format = "kafka"`` writes topics through Spark's Kafka sink.
Without a broker, ``"parquet"`` writes each topic as a folder of key/value
rows: append-mode outputs use the file sink (exactly once), update-mode
outputs (which the file sink rejects) go through ``foreachBatch`` that
appends each micro-batch tagged with its batch id, the same log a topic
would hold (repeats included).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampType

from ..config import JobConfig
from ..operators import events as E
from ..operators import windows as W
from ..sources.io import kafka_writer_options, read_events_stream
from . import count_windows as CW
from .upsert import KeyedTable


@dataclass(frozen=True)
class StreamSinks:
    """Where the jobs write: ``kafka`` topics or a folder per topic (``parquet``)."""

    sink_format: str = "kafka"
    topic_root: str | None = None  # folder holding one sub-folder per topic when not kafka


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State of the queries started from now on lives in RocksDB, unless the session already names a provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "HDFSBackedStateStoreProvider" in (spark.conf.get(key) or "HDFSBackedStateStoreProvider"):
        spark.conf.set(key, STATE_STORE)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def flagged_stream(spark: SparkSession, cfg: JobConfig, with_incident: bool = False) -> DataFrame:
    return E.flag_events(E.parse_events(read_events_stream(spark, cfg)), with_incident)


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**trigger) if trigger else writer


def write_topic(
    messages: DataFrame,
    cfg: JobConfig,
    sinks: StreamSinks,
    topic: str,
    mode: str,
    name: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that writes ``key``/``value`` rows to ``topic`` with its own checkpoint."""
    checkpoint = f"{cfg.checkpoint_dir}/{name}"
    rows = messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
    if sinks.sink_format == "kafka":
        writer = (
            rows.writeStream.format("kafka")
            .options(**kafka_writer_options(cfg, topic))
            .option("checkpointLocation", checkpoint)
            .outputMode(mode)
        )
        return _trigger(writer, trigger).start()
    path = f"{sinks.topic_root}/{topic}"
    if mode == "append":
        writer = (
            rows.writeStream.format("parquet")
            .option("path", f"{path}/{name}")
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
        )
        return _trigger(writer, trigger).start()

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        # Idempotent per batch id: a replayed batch overwrites its own folder.
        batch.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")

    writer = rows.writeStream.foreachBatch(append_batch).option("checkpointLocation", checkpoint).outputMode(mode)
    return _trigger(writer, trigger).start()


def write_features(
    features: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, partition_by_date: bool = True
) -> StreamingQuery:
    """Closed windows appended to a parquet folder (append mode: a window is written once, after the watermark passes its end).

    With ``partition_by_date`` the folder is partitioned by ``window_date``
    (UTC date of the window start), so readers of a date range prune files
    instead of listing the whole history.
    """
    if partition_by_date:
        features = features.withColumn(
            "window_date", F.expr("date_from_unix_date(CAST(unix_seconds(window_start) div 86400 AS INT))")
        )
    writer = (
        features.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if partition_by_date:
        writer = writer.partitionBy("window_date")
    return _trigger(writer, trigger).start()


def print_rows(batch: DataFrame, batch_id: int) -> None:
    """Every row of a micro-batch as one JSON line, not truncated; the driver holds one partition at a time."""
    for line in batch.toJSON().toLocalIterator():
        print(line, flush=True)


def preview(df: DataFrame, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Rows printed as they come (no checkpoint)."""
    return _trigger(df.writeStream.foreachBatch(print_rows).outputMode(mode), trigger).start()


def compact_features(spark: SparkSession, path: str, into: str, files_per_date: int = 1) -> None:
    """Rewrite a feature folder with ``files_per_date`` files per ``window_date`` (a stream leaves one per task and batch).

    The result goes to a new folder, so readers of the old one are not
    disturbed; a date is spread by driver, so no date meets in one task when
    more files are asked for.
    """
    table = spark.read.parquet(path)
    part = F.pmod(F.xxhash64("driver_id", "window_start"), F.lit(files_per_date))
    table.repartition(F.col("window_date"), part).write.partitionBy("window_date").parquet(into)


def start_alerts(spark, cfg: JobConfig, sinks: StreamSinks, trigger=None) -> StreamingQuery:
    return write_topic(E.build_alerts(flagged_stream(spark, cfg)), cfg, sinks, cfg.alert_topic, "append", "alerts", trigger)


def start_features(spark, cfg: JobConfig, trigger=None) -> StreamingQuery:
    tumbling = W.tumbling_features(flagged_stream(spark, cfg), watermark=cfg.watermark)
    return write_features(
        tumbling, f"{cfg.output_dir}/tumbling_1m", f"{cfg.checkpoint_dir}/features_tumbling_1m", trigger,
        cfg.partition_features_by_date,
    )


def start_sliding(spark, cfg: JobConfig, sinks: StreamSinks | None = None, trigger=None) -> StreamingQuery:
    """Sliding 5-minute windows in update mode: console preview, or a key/value log when ``sinks`` is given."""
    sliding = W.sliding_features(flagged_stream(spark, cfg), watermark=cfg.watermark)
    if sinks is None:
        return preview(sliding, "update", trigger)
    msgs = E.to_payload(sliding)
    return write_topic(msgs, cfg, sinks, "sliding_features", "update", "features_sliding_5m", trigger)


def start_feature_topic(spark, cfg: JobConfig, sinks: StreamSinks, trigger=None) -> StreamingQuery:
    tumbling = W.tumbling_features(flagged_stream(spark, cfg), watermark=cfg.watermark)
    return write_topic(E.to_payload(tumbling), cfg, sinks, cfg.feature_topic, "append", "features_kafka", trigger)


def start_event_decisions(spark, cfg: JobConfig, sinks: StreamSinks, trigger=None) -> StreamingQuery:
    flagged = flagged_stream(spark, cfg, with_incident=True)
    return write_topic(
        E.build_event_decisions(flagged), cfg, sinks, cfg.decision_topic, "append", "event_interventions", trigger
    )


def numbered_stream(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """Flagged events with ``event_no``, their arrival number (from 1), of a source with offsets.

    One sequence over the stream needs a topic folder, or a broker's topic of one partition.
    """
    messages = read_events_stream(spark, cfg, with_offset=True)
    return E.flag_events(E.parse_events(messages, keep=("offset",))).withColumn("event_no", F.col("offset") + 1)


LAST_EVENTS = "last_events"


def start_last_events(spark, cfg: JobConfig, trigger=None) -> StreamingQuery:
    """Every driver's last-N-events buffers, appended as they close (and, open, at the next tick) to ``output_dir/last_events``."""
    use_rocksdb(spark)
    states = CW.buffer_states(numbered_stream(spark, cfg), cfg.window_events, cfg.tick_every)
    writer = (
        states.writeStream.format("parquet")
        .option("path", f"{cfg.output_dir}/{LAST_EVENTS}")
        .option("checkpointLocation", f"{cfg.checkpoint_dir}/{LAST_EVENTS}")
        .outputMode("append")
    )
    return _trigger(writer, trigger).start()


def open_buffers(spark: SparkSession, cfg: JobConfig, seq: str = "event_no") -> DataFrame:
    """The buffers that no later event has closed, from the query's state: one row per driver, columns as in the output."""
    state = spark.read.format("statestore").option("stateVarName", "open").load(f"{cfg.checkpoint_dir}/{LAST_EVENTS}")
    rows = state.select("key.driver_id", *[F.col(f"value.{c}") for c in CW.FEATURES])
    return rows.withColumnRenamed("seq", seq)


def start_upsert(updates: DataFrame, table: KeyedTable, checkpoint: str, trigger=None) -> StreamingQuery:
    """An update-mode stream kept as its latest row per key (``table``) instead of a log of all updates."""
    writer = updates.writeStream.foreachBatch(table.merge_batch).option("checkpointLocation", checkpoint).outputMode("update")
    return _trigger(writer, trigger).start()


SLIDING_TABLE, DECISION_TABLE = "sliding_5m_latest", "window_decisions_latest"


def sliding_table(cfg: JobConfig, schema) -> KeyedTable:
    return KeyedTable(f"{cfg.output_dir}/{SLIDING_TABLE}", ("driver_id", "window_start"), schema)


def start_sliding_table(spark, cfg: JobConfig, trigger=None) -> StreamingQuery:
    """Sliding 5-minute windows as a keyed table: every window's latest state."""
    sliding = W.sliding_features(flagged_stream(spark, cfg), watermark=cfg.watermark)
    return start_upsert(sliding, sliding_table(cfg, sliding.schema), f"{cfg.checkpoint_dir}/{SLIDING_TABLE}", trigger)


def decision_table(cfg: JobConfig, schema) -> KeyedTable:
    return KeyedTable(f"{cfg.output_dir}/{DECISION_TABLE}", ("driver_id", "window_start"), schema)


def start_decision_table(spark, cfg: JobConfig, trigger=None) -> StreamingQuery:
    """Window decisions as a keyed table: the decision last sent for each window."""
    windowed = W.decision_windows(flagged_stream(spark, cfg, with_incident=True), watermark=cfg.watermark)
    rows = W.build_window_decision_rows(windowed)
    return start_upsert(rows, decision_table(cfg, rows.schema), f"{cfg.checkpoint_dir}/{DECISION_TABLE}", trigger)


#: What the state of a feature query holds per window, in the order of the aggregates.
_STATE_FIELDS = (
    "event_count bigint, km double, speed double, speeds bigint, speeding_count bigint, hard_braking_count bigint, harsh_acceleration_count bigint, "
    "sharp_cornering_count bigint, night_event_count bigint, bad_weather_event_count bigint, phone_usage_count bigint, risk_event_count bigint, max_speed double"
)


def open_windows(spark: SparkSession, cfg: JobConfig, query: str = "features_tumbling_1m") -> DataFrame:
    """The windows that a feature query has not closed yet, from its state: what it would go on with after a restart."""
    state = spark.read.format("statestore").load(f"{cfg.checkpoint_dir}/{query}")
    rows = state.select("key.driver_id", "key.window", F.col("value").cast(f"struct<{_STATE_FIELDS.replace(' ', ':').replace(',:', ',')}>").alias("v"))
    counts = [c.split()[0] for c in _STATE_FIELDS.split(", ") if c.split()[0].endswith("_count")]
    return rows.select(
        "driver_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[F.col(f"v.{c}").alias(c) for c in counts],
        F.round("v.km", 4).alias("km_driven"),
        F.round(F.col("v.speed") / F.col("v.speeds"), 2).alias("avg_speed"),
        F.col("v.max_speed").alias("max_speed"),
    )


def start_window_decisions(spark, cfg: JobConfig, sinks: StreamSinks, trigger=None) -> StreamingQuery:
    """Windowed decisions in update mode: a window's decision is re-sent whenever its state changes."""
    flagged = flagged_stream(spark, cfg, with_incident=True)
    windowed = W.decision_windows(flagged, watermark=cfg.watermark)
    return write_topic(
        W.build_window_decisions(windowed), cfg, sinks, cfg.decision_topic, "update", "window_interventions", trigger
    )


def run_features_job(spark, cfg: JobConfig, sinks: StreamSinks, trigger=None) -> list[StreamingQuery]:
    """Alerts, tumbling features to parquet, sliding preview; optional event preview and feature topic."""
    use_rocksdb(spark)
    queries = [start_alerts(spark, cfg, sinks, trigger), start_features(spark, cfg, trigger)]
    if cfg.show_console:
        queries.append(preview(E.event_preview(flagged_stream(spark, cfg)), "append", trigger))
        queries.append(start_sliding(spark, cfg, None, trigger))
    if cfg.write_feature_topic:
        queries.append(start_feature_topic(spark, cfg, sinks, trigger))
    return queries


def run_decisions_job(spark, cfg: JobConfig, sinks: StreamSinks, trigger=None) -> list[StreamingQuery]:
    use_rocksdb(spark)
    queries = [start_event_decisions(spark, cfg, sinks, trigger), start_window_decisions(spark, cfg, sinks, trigger)]
    if cfg.show_console:
        flagged = flagged_stream(spark, cfg, with_incident=True)
        decisions = W.build_window_decisions(W.decision_windows(flagged, watermark=cfg.watermark))
        queries.append(preview(decisions.select("value"), "update", trigger))
    return queries


def start_stateless_fanout(spark, cfg: JobConfig, sinks: StreamSinks, trigger=None) -> StreamingQuery:
    """One read of the raw topic feeding every stateless output (alerts and event decisions).

    The separate queries read and parse the topic once each; here each
    micro-batch is parsed and flagged once, kept for the two writes and
    released.  Folder sinks are written per batch id (a replayed batch
    overwrites its own output); the Kafka sink is at-least-once on replay.
    """
    flagged = flagged_stream(spark, cfg, with_incident=True)
    outputs = (
        (cfg.alert_topic, "alerts", E.build_alerts),
        (cfg.decision_topic, "event_interventions", E.build_event_decisions),
    )

    def fan_out(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for topic, name, build in outputs:
                rows = build(batch).selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
                if sinks.sink_format == "kafka":
                    rows.write.format("kafka").options(**kafka_writer_options(cfg, topic)).save()
                else:
                    rows.write.mode("overwrite").parquet(f"{sinks.topic_root}/{topic}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = flagged.writeStream.foreachBatch(fan_out).option("checkpointLocation", f"{cfg.checkpoint_dir}/stateless")
    return _trigger(writer, trigger).start()


def run_combined_job(spark, cfg: JobConfig, sinks: StreamSinks, trigger=None) -> list[StreamingQuery]:
    """Both jobs in one session with three reads of the topic: stateless fan-out, tumbling features, window decisions."""
    use_rocksdb(spark)
    return [
        start_stateless_fanout(spark, cfg, sinks, trigger),
        start_features(spark, cfg, trigger),
        start_window_decisions(spark, cfg, sinks, trigger),
    ]


def await_any(spark: SparkSession, queries: list[StreamingQuery] | None = None) -> None:
    """Block until any query of the session ends (a failed query re-raises its error)."""
    spark.streams.awaitAnyTermination()


def run_until_done(queries: list[StreamingQuery]) -> None:
    """For ``availableNow`` triggers: wait for every query to drain its input."""
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def topic_log(spark: SparkSession, sinks: StreamSinks, topic: str, name: str) -> DataFrame:
    """What query ``name`` wrote to ``topic`` (a folder sink): key, value and, for update mode, batch_id."""
    return spark.read.parquet(f"{sinks.topic_root}/{topic}/{name}")


#: Types whose values an aggregate can change in place.
FIXED_WIDTH = (NumericType, BooleanType, DateType, TimestampType)


def latest_updates(log: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert view of an update-mode log: the last row per key by batch id.

    A ``max_by`` aggregate: each input partition reduces a key to one partial row before the shuffle.  Values of
    fixed width are taken one by one, which Spark can hash; a struct or text in the aggregate means a sort.  A key
    stands once per batch, so all of them come from one row.
    """
    rest = [c for c in log.columns if c not in keys]
    if all(isinstance(log.schema[c].dataType, FIXED_WIDTH) for c in rest):
        return log.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in rest])
    last = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col("batch_id")).alias("_last")
    return log.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def with_paths(cfg: JobConfig, root: str, source_path: str, source_format: str = "parquet") -> JobConfig:
    """A config whose checkpoints / outputs live under ``root`` and whose source is a message folder."""
    return replace(
        cfg,
        checkpoint_dir=f"{root}/checkpoints",
        output_dir=f"{root}/features",
        source_format=source_format,
        source_path=source_path,
    )

