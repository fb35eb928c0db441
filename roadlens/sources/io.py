"""Sources and sinks: message streams, feature store, premium history, model outputs, decisions.

Broker I/O goes through Spark's own ``kafka`` source / sink; file formats
stand in for a broker where none is available (a folder of ``key``/``value``
rows plays the part of a topic).  Everything is written by the executors in
parallel; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import JobConfig
from ..schemas import DECISION_SCHEMA, FEATURE_SCHEMA, PREMIUM_HISTORY_SCHEMA
from .topic_log import FORMAT as TOPIC_LOG
from .topic_log import read_topic_stream

MESSAGE_SCHEMA = "key string, value string"


# --- file-system helpers --------------------------------------------------------------------------


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def csv_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> files of a CSV file or folder (one line per file is read here, no data)."""
    fs, p = _fs_path(spark, path)
    names = [p] if fs.getFileStatus(p).isFile() else [s.getPath() for s in fs.listStatus(p) if s.isFile()]
    found: dict[str, list[str]] = {}
    jvm = spark.sparkContext._jvm
    for name in sorted(names, key=lambda f: f.toString()):
        if name.getName().startswith(("_", ".")):
            continue
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(name), "UTF-8"))
        try:
            header = reader.readLine()
        finally:
            reader.close()
        if header:
            found.setdefault(header, []).append(name.toString())
    return found


def read_csv_by_name(spark: SparkSession, path: str) -> DataFrame:
    """All files as text columns matched by name: files of one header are read together, absent columns are null."""
    parts = [spark.read.option("header", True).csv(files) for files in csv_headers(spark, path).values()]
    if not parts:
        raise ValueError(f"no CSV file with a header in {path}")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


# --- message streams ------------------------------------------------------------------------------


def _rate_limit(cfg: JobConfig, option: str) -> dict[str, str]:
    return {} if cfg.max_per_trigger is None else {option: str(cfg.max_per_trigger)}


def read_events_stream(spark: SparkSession, cfg: JobConfig, topic: str | None = None, with_offset: bool = False) -> DataFrame:
    """Streaming ``key``/``value`` strings of the raw topic: a broker, a topic folder with offsets, or a folder of message files.

    ``with_offset`` adds ``offset``, the message's place in the topic, where
    the source has one (of a broker: within its partition).
    """
    topic = topic or cfg.raw_topic
    columns = ["key", "value", *(["offset"] if with_offset else [])]
    if cfg.source_format == TOPIC_LOG:
        if not cfg.source_path:
            raise ValueError("source_path is required for a topic folder")
        return read_topic_stream(spark, cfg.source_path, cfg.starting_offsets).select(*columns)
    if with_offset and cfg.source_format != "kafka":
        raise ValueError(f"messages of a {cfg.source_format} folder have no offsets; use {TOPIC_LOG}")
    if cfg.source_format == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", cfg.starting_offsets)
            .options(**_rate_limit(cfg, "maxOffsetsPerTrigger"))
            .options(**cfg.source_options)
            .load()
        )
        return raw.withColumns({c: F.col(c).cast("string") for c in ("key", "value")}).select(*columns)
    if not cfg.source_path:
        raise ValueError("source_path is required for a file source")
    reader = spark.readStream.format(cfg.source_format).options(**_rate_limit(cfg, "maxFilesPerTrigger")).options(**cfg.source_options)
    if cfg.source_format == "text":
        return reader.load(cfg.source_path).select(F.lit(None).cast("string").alias("key"), "value")
    return reader.schema(MESSAGE_SCHEMA).load(cfg.source_path)


def kafka_writer_options(cfg: JobConfig, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": cfg.bootstrap_servers, "topic": topic}


def decision_source_options(cfg: JobConfig, starting_offsets: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": cfg.bootstrap_servers, "subscribe": cfg.decision_topic, "startingOffsets": starting_offsets}


def decode_decisions(raw: DataFrame) -> DataFrame:
    """Key kept (null allowed), value decoded with the union schema of all decisions."""
    return raw.select("key", F.from_json("value", DECISION_SCHEMA).alias("decision")).select("key", "decision.*")


def read_decisions(spark: SparkSession, cfg: JobConfig, path: str | None = None) -> DataFrame:
    """All decisions so far, as a batch table from the earliest offset (or of a folder)."""
    if path is None:
        raw = spark.read.format("kafka").options(**decision_source_options(cfg, "earliest")).load()
        raw = raw.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
    else:
        raw = spark.read.schema(MESSAGE_SCHEMA).parquet(path)
    return decode_decisions(raw)


def read_decisions_stream(spark: SparkSession, cfg: JobConfig, path: str | None = None) -> DataFrame:
    """Decisions as they arrive: a stream from the latest offset (a batch read cannot begin there), or of a folder."""
    if path is None:
        raw = spark.readStream.format("kafka").options(**decision_source_options(cfg, "latest")).load()
        raw = raw.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
    else:
        raw = spark.readStream.schema(MESSAGE_SCHEMA).parquet(path)
    return decode_decisions(raw)


# --- feature store ----------------------------------------------------------------------------------


def load_features(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Feature table from a parquet folder, a parquet file, or a ``.csv`` file with a header.

    Columns are matched by name over all files: one that some files lack (an
    older layout) is null in their rows, and none is lost.  CSV columns are
    typed by ``schema`` (default: the feature table's types), so nothing is
    inferred from the content; a column without a known type stays text.
    Parquet files that give one column two types are an error, as one of them
    would be misread.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"feature table not found: {path}")
    if not path.lower().endswith(".csv"):  # a CSV file, or a folder of CSV parts named *.csv
        return spark.read.option("mergeSchema", True).parquet(path)  # else the layout of one file would stand for all
    types = {f.name: f.dataType for f in (schema or FEATURE_SCHEMA).fields}
    text = read_csv_by_name(spark, path)
    return text.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in text.columns])


def write_features_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


# --- premium history --------------------------------------------------------------------------------


def load_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The premium history, or None when there is none yet.

    Columns are matched by name, file by file, and cast to the history schema;
    a column that an older file lacks comes back null, and the order of a
    file's columns does not matter.
    """
    from ..operators.pricing import conform_history

    if not path_exists(spark, path):
        return None
    if path.lower().endswith(".csv"):
        return conform_history(read_csv_by_name(spark, path))
    return spark.read.schema(PREMIUM_HISTORY_SCHEMA).parquet(path)


def append_history(df: DataFrame, path: str) -> None:
    """Add this run's rows, as the 17 history columns, to the history (append only; old rows are not rewritten)."""
    from ..operators.pricing import conform_history

    df = conform_history(df)
    if path.lower().endswith(".csv"):
        df.write.mode("append").option("header", True).csv(path)
    else:
        df.write.mode("append").parquet(path)


def premium_update_messages(df: DataFrame) -> DataFrame:
    """One message per driver: key = driver id, value = JSON of every column."""
    return df.select(F.col("driver_id").alias("key"), F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def publish_updates(df: DataFrame, cfg: JobConfig, path: str | None = None) -> None:
    """Batch publish of premium updates to the broker (or to a message folder)."""
    msgs = premium_update_messages(df)
    if path is not None:
        msgs.write.mode("append").parquet(path)
        return
    msgs.write.format("kafka").options(**kafka_writer_options(cfg, cfg.premium_topic)).save()


# --- model outputs and decisions ---------------------------------------------------------------------


def write_outputs(
    spark: SparkSession,
    out_dir: str,
    training: DataFrame,
    coefficients: DataFrame,
    predictions: DataFrame,
    metrics: DataFrame,
    summary: str,
) -> None:
    """Training set, coefficients and test predictions as CSV; metrics as JSON; summary as text."""
    training.write.mode("overwrite").option("header", True).csv(f"{out_dir}/training_dataset.csv")
    coefficients.write.mode("overwrite").option("header", True).csv(f"{out_dir}/glm_coefficients.csv")
    predictions.write.mode("overwrite").option("header", True).csv(f"{out_dir}/glm_test_predictions.csv")
    metrics.write.mode("overwrite").json(f"{out_dir}/glm_metrics")
    spark.createDataFrame([(line,) for line in summary.splitlines()], "value string").write.mode("overwrite").text(
        f"{out_dir}/glm_summary"
    )


def write_decisions(df: DataFrame, path: str) -> None:
    """Decisions as JSON lines (one object per decision)."""
    df.write.mode("append").json(path)
