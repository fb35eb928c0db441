"""Late rows kept: a stream is parted into rows on time and rows behind the watermark, and none is lost.

Spark drops rows behind the watermark inside its stateful operators.  Here a
query in front of them writes each micro-batch to two folders: ``on_time``
and ``late``.  The watermark of a batch is the highest event time of the
batches before it less the delay; it is published per batch id, so a batch
that is replayed is parted in the same way and overwrites its own output.
A feature query that reads the ``on_time`` folder drops nothing.

Rows without an event time belong to no window and go to ``late``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import versions as V


@dataclass(frozen=True)
class LateSplit:
    path: str
    delay_ms: int
    time_col: str = "event_time_ts"

    def _marks(self) -> str:
        return f"{self.path}/watermarks"

    def watermark(self, spark: SparkSession, batch_id: int) -> int | None:
        """The watermark (epoch milliseconds) that a batch is parted by; None before any event time was seen."""
        before = [n for n in V.versions(spark, self._marks()) if n < batch_id]
        high = V.load_version(spark, self._marks(), before[-1])["high"] if before else None
        return None if high is None else high - self.delay_ms

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Part one micro-batch; for ``foreachBatch``."""
        spark = batch.sparkSession
        mark = self.watermark(spark, batch_id)
        at = F.unix_millis(self.time_col)
        on_time = F.coalesce(at >= F.lit(mark) if mark is not None else at.isNotNull(), F.lit(False))
        rows = batch.withColumn("on_time", on_time).persist()
        try:
            for kind, part in (("on_time", rows.filter("on_time")), ("late", rows.filter("NOT on_time"))):
                part.drop("on_time").write.mode("overwrite").parquet(f"{self.path}/{kind}/batch_id={batch_id}")
            high = rows.agg(F.max(at)).first()[0]
        finally:
            rows.unpersist()
        if batch_id not in V.versions(spark, self._marks()):
            known = None if mark is None else mark + self.delay_ms
            V.publish(spark, self._marks(), batch_id, {"high": max((h for h in (high, known) if h is not None), default=None)})
            V.forget(spark, self._marks(), batch_id - 2)

    def read(self, spark: SparkSession, kind: str, schema) -> DataFrame:
        """The rows of ``on_time`` or ``late`` so far."""
        return spark.read.schema(schema).parquet(f"{self.path}/{kind}").select(*schema.fieldNames())


def start_late_split(events: DataFrame, split: LateSplit, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    writer = events.writeStream.foreachBatch(split.write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
