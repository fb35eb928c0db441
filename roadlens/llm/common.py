"""Small helpers shared by the operators: text normalisation, written tables, size-checked broadcasts.

* Intermediate tables are written as Parquet under the shared folder of the
  session (``spark.checkpoint.dir``), so a lost executor never costs more
  than the stage it was running.
* A side is broadcast only after its rows were counted against a stated
  bound; beyond the bound the same join runs as a shuffle join.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: For ``bytes.translate``: lower-cases A-Z and leaves every other byte (UTF-8 safe).
LOWER_TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())

#: Most bytes of one broadcast side (rows times the stated row width).
BROADCAST_BYTES = 32 << 20


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is (``lower`` is the same on pure ASCII)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: the rows are computed once and survive lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table made by ``write_table`` that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, row_bytes: int, rows: int | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its counted rows times ``row_bytes`` stay within ``limit``; else as it is."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows * row_bytes <= limit else df


def text_digest(text: Column) -> Column:
    """SHA-256 of the text as it stands (null as empty); with the document id it names a row."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def without_rows(docs: DataFrame, losers: DataFrame, n_losers: int) -> DataFrame:
    """``docs`` without the rows named by ``losers(doc_id, digest)``; ids compare null-safe, texts by digest.

    No shuffle of the texts while the losers fit the broadcast bound, else one
    shuffle anti join on the (nearly unique) pair, so no key is hot.
    """
    if n_losers == 0:
        return docs
    gone = losers.select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (text_digest(F.col("row.text")) == F.col("gone_digest"))
    return row.join(small_side(gone, 120, n_losers), same, "left_anti").select("row.*")


def ranked(df: DataFrame, *order: str, group: str | None = None, total: str | None = None) -> DataFrame:
    """Written table: ``df`` with ``rank``, the exact place (from 0) of each row in ``order``, within ``group`` if given.

    Rows are range-sorted; a row's rank is its place in its partition plus the
    rows of the partitions before it.  Only one small row per partition (and
    group) meets the rows again, broadcast if they fit the bound; nothing is
    gathered into one task.  ``total`` names a column for the rows of the group.
    """
    keys = [group, *order] if group else list(order)
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    placed = write_table(placed.withColumn("part", F.shiftright("place", 33)), "placed")
    by = [group] if group else []
    every = Window.partitionBy(*by)
    earlier = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part", *by).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    starts = write_table(
        starts.select(
            "part",
            *by,
            (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
            *([F.sum("n").over(every).alias(total)] if total else []),
        ),
        "starts",
    )
    found = placed.join(small_side(starts, 96), ["part", *by])
    named = [F.col(f"`{c}`") for c in df.columns]
    return found.select(*named, (F.col("place") + F.col("shift")).alias("rank"), *([total] if total else []))


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package when the session was started from another folder.

    On a cluster the package is installed, or shipped with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
