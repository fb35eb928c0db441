"""A topic without a broker: messages with numbered offsets in a shared folder, as a streaming and batch source.

Layout of a topic folder::

    segments/<first>-<next>-<tag>/part-*.parquet   offset, key, value; sorted by offset
    manifests/<first>-<next>.json                  one line per file: its name, first and next offset

``append_messages`` numbers a batch of messages behind the last offset (a
range sort and partition offsets, nothing gathered), writes the segment, and
publishes it by renaming its manifest into place.  A reader sees published
segments only, so a writer that dies leaves no half segment.  One writer at a
time, as with one producer of a partition: of two that claim the same offsets
the second finds the manifest taken and fails.

``TopicLog`` is a Spark data source over such a folder.  As a stream it
starts at ``startingOffsets``: ``latest`` (messages published before the
query's first start are not read), ``earliest`` or a number.  Its progress is
an offset in the query's checkpoint, so a restart goes on where the last
batch ended, whatever was published meanwhile.  Tasks read only the files, and
of these only the rows, between two offsets.

The folder is given as Spark knows it; tasks open it through the ``pyarrow``
file system of its scheme.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "offset long, key string, value string"
FORMAT = "topic_log"


# --- writing ------------------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def end_offset(spark: SparkSession, path: str) -> int:
    """The offset that the next message will have."""
    fs, p = _fs(spark, f"{path}/manifests")
    if not fs.exists(p):
        return 0
    return max((_ends(s.getPath().getName())[1] for s in fs.listStatus(p) if s.getPath().getName().endswith(".json")), default=0)


def _ends(name: str) -> tuple[int, int]:
    first, _, following = name.removesuffix(".json").partition("-")
    return int(first), int(following)


def append_messages(messages: DataFrame, path: str, *order: str) -> int:
    """Publish ``messages(key, value, ...)`` behind the last offset, in ``order`` (as they come if none); returns the end offset."""
    from ..operators.rolling import with_sequence

    spark = messages.sparkSession
    first = end_offset(spark, path)
    rows = messages if order else messages.withColumn("_row", F.monotonically_increasing_id())
    numbered = with_sequence(rows, *(order or ("_row",)), name="offset").select((F.col("offset") + (first - 1)).alias("offset"), "key", "value")
    segment = f"{first:020d}-{uuid.uuid4().hex}"
    numbered.sortWithinPartitions("offset").write.parquet(f"{path}/segments/{segment}")
    written = spark.read.parquet(f"{path}/segments/{segment}")
    files = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("next"), F.count(F.lit(1)).alias("n"))
    found = sorted((r["first"], r["next"], r["n"], r["file"]) for r in files.collect())  # one row per file
    if not found:
        return first
    end = max(f[1] for f in found)  # a task that is given several parts may write a file with others' offsets between its own
    assert found[0][0] == first and sum(f[2] for f in found) == end - first, "offsets have gaps"
    lines = "".join(json.dumps({"file": f"{segment}/{name}", "first": a, "next": b}) + "\n" for a, b, _, name in found)
    _publish(spark, f"{path}/manifests", f"{first:020d}-{end:020d}.json", lines)
    return end


def _publish(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A file that appears whole or not at all; an error if it, or another that begins at the same offset, is there."""
    jvm = spark._jvm
    fs, p = _fs(spark, folder)
    fs.mkdirs(p)
    if any(s.getPath().getName().split("-")[0] == name.split("-")[0] for s in fs.listStatus(p)):
        raise RuntimeError(f"another writer has published offset {name.split('-')[0]} of {folder}")
    temp = jvm.org.apache.hadoop.fs.Path(f"{folder}/_{uuid.uuid4().hex}")
    out = fs.create(temp, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(temp, jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")):
        raise RuntimeError(f"could not publish {folder}/{name}")


# --- reading ------------------------------------------------------------------------------------------


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def _manifests(path: str) -> list[tuple[int, int, str]]:
    files, root = _open(path)
    listed = files.get_file_info(pafs.FileSelector(f"{root}/manifests", allow_not_found=True))
    return sorted((*_ends(f.base_name), f.path) for f in listed if f.base_name.endswith(".json"))


class FileRange(InputPartition):
    """The rows of one file between two offsets."""

    def __init__(self, file: str, start: int, end: int):
        super().__init__((file, start, end))
        self.file, self.start, self.end = file, start, end


def file_ranges(path: str, start: int, end: int) -> list[FileRange]:
    """The files with offsets in [start, end); of the manifests only those that overlap are opened."""
    files, _ = _open(path)
    found = []
    for first, following, manifest in _manifests(path):
        if first < end and following > start:
            with files.open_input_stream(manifest) as lines:
                entries = [json.loads(line) for line in lines.read().decode().splitlines()]
            found += [FileRange(e["file"], max(start, e["first"]), min(end, e["next"])) for e in entries if e["first"] < end and e["next"] > start]
    return found


def read_range(path: str, part: FileRange) -> Iterator:
    """Record batches of one file's rows in its range; row groups outside it are skipped by their statistics."""
    files, root = _open(path)
    with files.open_input_file(f"{root}/segments/{part.file}") as source:
        table = pq.ParquetFile(source)
        groups = []
        for i in range(table.num_row_groups):
            stats = table.metadata.row_group(i).column(0).statistics
            if stats is None or not stats.has_min_max or stats.min < part.end and stats.max >= part.start:
                groups.append(i)
        for batch in table.iter_batches(row_groups=groups, columns=["offset", "key", "value"]):
            offset = batch["offset"]
            batch = batch.filter(pc.and_(pc.greater_equal(offset, part.start), pc.less(offset, part.end)))
            if batch.num_rows:
                yield batch


class LogReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[FileRange]:
        return file_ranges(self.path, 0, max((n for _, n, _ in _manifests(self.path)), default=0)) or [FileRange("", 0, 0)]

    def read(self, partition: FileRange) -> Iterator:
        return read_range(self.path, partition) if partition.file else iter(())


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str):
        self.path, self.starting = path, starting

    def _end(self) -> int:
        return max((n for _, n, _ in _manifests(self.path)), default=0)

    def initialOffset(self) -> dict:
        return {"offset": self._end() if self.starting == "latest" else 0 if self.starting == "earliest" else int(self.starting)}

    def latestOffset(self) -> dict:
        return {"offset": self._end()}

    def partitions(self, start: dict, end: dict) -> list[FileRange]:
        return file_ranges(self.path, start["offset"], end["offset"])

    def read(self, partition: FileRange) -> Iterator:
        return read_range(self.path, partition)


class TopicLog(DataSource):
    """Options: ``path`` and, for streams, ``startingOffsets`` (``latest``, ``earliest`` or an offset)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _path(self) -> str:
        if not self.options.get("path"):
            raise ValueError("option path is required: the topic's folder")
        return self.options["path"].rstrip("/")

    def reader(self, schema) -> LogReader:
        return LogReader(self._path())

    def streamReader(self, schema) -> LogStreamReader:
        starting = self.options.get("startingOffsets", "latest")
        if starting not in ("latest", "earliest") and not starting.isdigit():
            raise ValueError(f"startingOffsets must be latest, earliest or a number, not {starting!r}")
        return LogStreamReader(self._path(), starting)


def use_topic_log(spark: SparkSession) -> None:
    """Make the format known to the session.

    A Python source has no ``availableNow`` of its own: without Spark's wrapper
    such a run is one batch, and the batch that fires timers and closes windows
    after it would not run.  Offsets here are fixed numbers, so the wrapper is safe.
    """
    from ..session import reachable

    reachable(spark)
    spark.dataSource.register(TopicLog)
    spark.conf.set("spark.sql.streaming.triggerAvailableNowWrapper.enabled", "true")


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    """All published messages as a table."""
    use_topic_log(spark)
    return spark.read.format(FORMAT).option("path", path).load()


def read_topic_stream(spark: SparkSession, path: str, starting_offsets: str = "latest") -> DataFrame:
    """The messages as a stream of (offset, key, value)."""
    use_topic_log(spark)
    return spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting_offsets).load()
