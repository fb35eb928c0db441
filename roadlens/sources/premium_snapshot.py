"""The latest premium of every driver as a bucketed table, so one driver's row is read from one bucket.

``latest_premium(history, driver_id)`` has to scan a history that only grows.
The snapshot holds one row per driver, hashed by driver into ``buckets`` files
sorted by driver: a lookup opens one file of them, and within it the row
groups whose driver range fits.

``merge_run`` brings a scoring run in.  The old snapshot is read by bucket, so
it meets the run without being shuffled; only the run's rows move.  The new
version is written beside the old one and becomes current when its version
file appears: readers see the one or the other, and a run that dies leaves the
old one.  A run that is merged twice changes nothing (the later stamp wins,
as in ``latest_premium``).

Rows without a driver are not looked up and not kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pricing import conform_history, latest_premium
from ..schemas import PREMIUM_HISTORY_COLUMNS, PREMIUM_HISTORY_SCHEMA
from . import versions as V

BUCKETS = 64
#: Versions kept besides the current one, for readers that began with them.
KEPT = 1


def _named(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The bucketed files of ``path`` as a table; its name in the catalog is only needed to say how they are bucketed."""
    name = f"premium_snapshot_{uuid.uuid4().hex}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PREMIUM_HISTORY_SCHEMA.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (driver_id) SORTED BY (driver_id) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        return spark.table(name).select("*")
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files are not the catalog's


def _write(df: DataFrame, path: str, buckets: int) -> None:
    name = f"premium_snapshot_{uuid.uuid4().hex}"
    df.repartition(buckets, "driver_id").write.bucketBy(buckets, "driver_id").sortBy("driver_id").format("parquet").option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """One row per driver, or None when nothing has been merged yet."""
    found = V.current(spark, f"{path}/versions")
    return None if found is None else _named(spark, f"{path}/{found[1]['folder']}", found[1]["buckets"])


def lookup(spark: SparkSession, path: str, driver_id: str) -> DataFrame:
    """The driver's latest premium row (no row: unknown driver)."""
    snapshot = read_snapshot(spark, path)
    if snapshot is None:
        raise FileNotFoundError(f"no premium snapshot in {path}")
    return snapshot.filter(F.col("driver_id") == F.lit(driver_id))


def _order(prefix: str) -> Column:
    """What decides between two rows of a driver, as in ``latest_premium``."""
    rest = [c for c in PREMIUM_HISTORY_COLUMNS if c not in ("driver_id", "scored_at", "technical_premium")]
    stamp = F.col(f"{prefix}.scored_at")
    return F.struct(F.try_to_timestamp(stamp).alias("instant"), *[F.col(f"{prefix}.{c}").alias(c) for c in ("scored_at", "technical_premium", *rest)])


def merged(old: DataFrame, run: DataFrame) -> DataFrame:
    """The later row of each driver of the snapshot ``old`` and of the run."""
    new = latest_premium(conform_history(run).filter(F.col("driver_id").isNotNull())).select(*PREMIUM_HISTORY_COLUMNS)
    both = old.alias("o").join(new.alias("n"), F.col("o.driver_id") == F.col("n.driver_id"), "full_outer")
    take_new = F.col("o.driver_id").isNull() | (F.col("n.driver_id").isNotNull() & (_order("n") > _order("o")))
    return both.select(*[F.when(take_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in PREMIUM_HISTORY_COLUMNS])


def merge_run(run: DataFrame, path: str, buckets: int = BUCKETS) -> int:
    """Bring ``run`` (history rows) into the snapshot; returns the new version's number."""
    spark = run.sparkSession
    found = V.current(spark, f"{path}/versions")
    if found is None:
        number, rows = 0, latest_premium(conform_history(run).filter(F.col("driver_id").isNotNull())).select(*PREMIUM_HISTORY_COLUMNS)
    else:
        number, buckets = found[0] + 1, found[1]["buckets"]
        rows = merged(_named(spark, f"{path}/{found[1]['folder']}", buckets), run)
    folder = f"data/{number:020d}-{uuid.uuid4().hex}"
    _write(rows, f"{path}/{folder}", buckets)
    V.publish(spark, f"{path}/versions", number, {"folder": folder, "buckets": buckets})
    for old in V.versions(spark, f"{path}/versions"):
        if old < number - KEPT:
            V.delete(spark, f"{path}/{V.load_version(spark, f'{path}/versions', old)['folder']}")
    V.forget(spark, f"{path}/versions", number - KEPT)
    return number
