"""Session helpers: building a session for tests / bench and locating the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "roadlens") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the session the platform provides."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ROADLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package when the session was started from another folder.

    On a cluster the package is installed, or shipped with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (the cluster's shared location).  A
    session that names none gets a fresh local folder if it runs in one
    process (``local[...]``); on a cluster that would be a folder other nodes
    cannot read, so it is an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all nodes of {master} share")
        path = tempfile.mkdtemp(prefix="roadlens-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # a non-modifiable conf on some deployments; the context already knows it
            pass
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder (one per call)."""
    return f"{shared_dir(spark)}/roadlens/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back (columnar, prunable, no lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose owner no longer needs it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
