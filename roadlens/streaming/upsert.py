"""A keyed table that update-mode streams write into: the latest row per key, without the log of all updates.

A stream in update mode sends a key again whenever its row changes.  The log
of those rows only grows, and its latest state needs a scan of all of it.
Here the rows of a micro-batch are merged into hash buckets::

    data/batch=<id>/bucket=<i>/part-*.parquet   the buckets that batch <id> wrote, whole
    versions/<id>.json                          which batch wrote each bucket last

``merge_batch`` reads only the buckets that the batch touches, replaces the
rows of its keys and writes those buckets anew; the table changes when the
version file appears.  Its number is the batch id, so a batch that is
replayed after a failure finds its number and does nothing, and a batch that
died half way is written again from the version before it.  Bucket files that
no kept version names are deleted.

Cost per batch follows the touched buckets; choose ``buckets`` so that one fits
a task.  Keys are spread by hash, so a busy driver's windows lie in many
buckets.  A key that stands several times in one batch keeps one row: the
largest by ``order`` (update mode sends a key once per batch).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import versions as V

#: Versions kept besides the current one, for readers that began with them.
KEPT = 2


@dataclass(frozen=True)
class KeyedTable:
    path: str
    keys: Sequence[str]
    schema: StructType
    buckets: int = 32
    order: Sequence[str] = ()

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _versions(self) -> str:
        return f"{self.path}/versions"

    def _files(self, spark: SparkSession, owners: dict[str, int]) -> DataFrame:
        """The rows of the buckets in ``owners`` (bucket -> batch that wrote it)."""
        if not owners:
            return spark.createDataFrame([], self.schema)
        folders = [f"{self.path}/data/batch={batch}/bucket={bucket}" for bucket, batch in sorted(owners.items())]
        return spark.read.schema(self.schema).parquet(*folders)

    def read(self, spark: SparkSession) -> DataFrame:
        """The latest row of every key."""
        found = V.current(spark, self._versions())
        return self._files(spark, found[1]["owners"] if found else {})

    def merge_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Replace the rows of the batch's keys; for ``foreachBatch``."""
        spark = batch.sparkSession
        found = V.current(spark, self._versions())
        if found and found[0] >= batch_id:
            return  # a replay of what is already in the table
        owners = dict(found[1]["owners"]) if found else {}
        columns = self.schema.fieldNames()
        rows = batch.select(*[F.col(c) for c in columns])
        last = F.max_by(F.struct(*columns), F.struct(*[F.col(c) for c in (self.order or columns)])).alias("last")
        rows = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys]).agg(last).select("last.*").withColumn("bucket", self._bucket())
        rows = rows.persist()
        try:
            touched = [str(r["bucket"]) for r in rows.select("bucket").distinct().collect()]  # at most ``buckets``
            if touched:
                old = self._files(spark, {b: owners[b] for b in touched if b in owners}).withColumn("bucket", self._bucket())
                same = F.lit(True)
                for k in self.keys:
                    same = same & old[k].eqNullSafe(rows[k])
                kept = old.join(rows, same & (old["bucket"] == rows["bucket"]), "left_anti")
                whole = kept.unionByName(rows).repartition(len(touched), "bucket")
                whole.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/batch={batch_id}")
                owners |= {b: batch_id for b in touched}
        finally:
            rows.unpersist()
        V.publish(spark, self._versions(), batch_id, {"owners": owners})
        self._clean(spark)

    def _clean(self, spark: SparkSession) -> None:
        """Delete bucket files that none of the kept versions names, and older versions."""
        known = V.versions(spark, self._versions())
        if len(known) <= KEPT + 1:
            return
        gone, kept = known[: -KEPT - 1], known[-KEPT - 1 :]
        pairs = lambda numbers: {p for n in numbers for p in V.load_version(spark, self._versions(), n)["owners"].items()}
        for bucket, batch in pairs(gone) - pairs(kept):
            V.delete(spark, f"{self.path}/data/batch={batch}/bucket={bucket}")
        V.forget(spark, self._versions(), kept[0])
