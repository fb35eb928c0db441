"""Topic folders: offsets without gaps, streams that start and resume at an offset, published segments only."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from roadlens.config import JobConfig
from roadlens.sources import io as IO
from roadlens.sources import topic_log as T


def messages(spark, n, first=0):
    return spark.range(first, first + n).select((F.col("id") % 5).cast("string").alias("key"), F.col("id").cast("string").alias("value"), "id")


def drain(stream, path):
    q = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    return sum(p["numInputRows"] for p in q.recentProgress)


def test_offsets_follow_the_order_without_gaps(spark, tmp_path):
    path = str(tmp_path / "topic")
    assert T.end_offset(spark, path) == 0
    assert T.append_messages(messages(spark, 500).repartition(7), path, "id") == 500
    assert T.append_messages(messages(spark, 0), path, "id") == 500
    assert T.append_messages(messages(spark, 300, 500).repartition(3), path, "id") == 800
    rows = T.read_topic(spark, path).collect()
    assert sorted((r.offset, r.value, r.key) for r in rows) == [(i, str(i), str(i % 5)) for i in range(800)]


def test_a_stream_from_the_latest_offset_reads_what_comes_after_its_first_start(spark, tmp_path):
    path = str(tmp_path / "topic")
    T.append_messages(messages(spark, 100), path, "id")
    stream = lambda: T.read_topic_stream(spark, path)
    assert drain(stream(), str(tmp_path)) == 0
    T.append_messages(messages(spark, 40, 100), path, "id")
    assert drain(stream(), str(tmp_path)) == 40
    assert drain(stream(), str(tmp_path)) == 0
    T.append_messages(messages(spark, 7, 140), path, "id")
    assert drain(stream(), str(tmp_path)) == 7
    got = [r.offset for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == list(range(100, 147))


def test_a_stream_from_a_number_reads_within_files(spark, tmp_path):
    path = str(tmp_path / "topic")
    T.append_messages(messages(spark, 100), path, "id")
    assert drain(T.read_topic_stream(spark, path, "95"), str(tmp_path)) == 5
    assert [p.value for p in T.file_ranges(path, 95, 100)] and all(p.start >= 95 for p in T.file_ranges(path, 95, 100))
    assert T.file_ranges(path, 100, 100) == []


def test_unpublished_segments_are_not_read_and_offsets_are_published_once(spark, tmp_path):
    path = str(tmp_path / "topic")
    T.append_messages(messages(spark, 10), path, "id")
    messages(spark, 5).selectExpr("id + 10 AS offset", "key", "value").write.parquet(f"{path}/segments/00000000000000000010-died")
    assert T.read_topic(spark, path).count() == 10
    with pytest.raises(RuntimeError, match="another writer"):
        T._publish(spark, f"{path}/manifests", f"{0:020d}-{5:020d}.json", "")


def test_empty_topic_and_bad_options(spark, tmp_path):
    T.use_topic_log(spark)
    assert T.read_topic(spark, str(tmp_path / "none")).collect() == []
    assert drain(T.read_topic_stream(spark, str(tmp_path / "none")), str(tmp_path)) == 0
    with pytest.raises(Exception, match="startingOffsets"):
        drain(T.read_topic_stream(spark, str(tmp_path / "none"), "soon"), str(tmp_path / "x"))
    with pytest.raises(ValueError, match="no offsets"):
        IO.read_events_stream(spark, JobConfig(source_format="parquet", source_path="x"), with_offset=True)


def test_parts_that_share_a_task_out_of_order_are_published(spark, tmp_path):
    """Parts of unequal size are packed by size, so a file may hold the offsets before and behind another's."""
    keys = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in zip(keys, ("false", "3", "1")):
        spark.conf.set(k, v)
    path = str(tmp_path / "topic")
    try:
        assert T.append_messages(messages(spark, 400).withColumn("value", F.repeat("value", (F.col("id") * 37 % 11).cast("int"))), path, "id") == 400
        assert T.append_messages(messages(spark, 50, 400), path, "id") == 450
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(r.offset for r in T.read_topic(spark, path).collect()) == list(range(450))
    assert sum(len(b) for p in T.file_ranges(path, 100, 300) for b in T.read_range(path, p)) == 200
