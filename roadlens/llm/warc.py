"""WARC archives: a deterministic sharded writer with manifests, and the reader of what it wrote.

Writing:
1. One narrow scan gives the payload digests.  Payloads of at least
   ``LEAST_REVISIT`` bytes that occur more than once get a note per page: the
   page whose record holds the payload (the smallest page id).
2. Shard bounds are exact ranks of the page ids, so the same rows always make
   the same shards, whatever the cluster.  Pages and their notes go to their
   shard in one shuffle and are sorted there, a note just before its page.
3. Each task writes its shard record by record (one gzip member each, headers
   and digests made anew) and starts another file when the compressed size
   passes ``roll_bytes``.  It writes under a temporary name of its own attempt.
4. Commit: the rows that successful tasks returned are the manifest.  A second
   job renames exactly these files, then the final manifest is written; its
   presence is the commit.  Files of lost attempts are in no manifest and go
   with the temporary folder.  Renaming again after a lost executor is harmless.

Reading follows the manifest, streams member by member, and checks file,
block and payload digests.

Edge cases: null html is an empty payload.  A null url writes no target.
Control characters in a url are percent-encoded.  Null page ids sort first
and count as larger than any id when the holder of a payload is chosen.  Rows
that repeat a page id and payload are separate records; the first one holds
it.  An empty table makes an archive of no files.  Other columns are not read.
Executors need a pyarrow file system for the folder (local or mounted paths,
HDFS, S3, GCS).
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import drop_table, ranked, small_side, write_table

LEAST_REVISIT = 100
ROLL_BYTES = 256 << 20
#: Payload bytes of a shard: a 4096th of the archive between these two.
SHARD_BYTES = (16 << 20, 1 << 30)
DATE = "1970-01-01T00:00:00Z"
READ_BYTES = 1 << 20
CRLF = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "shard int, seq int, temp string, name string, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


# ---- records

def record_id(page_id: int | None, digest: str, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id} {digest} {copy}'.encode()).digest()[:16], version=5)}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member with one record; length and block digest come from the block."""
    headers = [*headers, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    head = CRLF.join([b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in headers)])
    zipped = zlib.compressobj(6, zlib.DEFLATED, 31)
    return zipped.compress(head + CRLF * 2 + block + CRLF * 2) + zipped.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, holder: tuple | None, copy: int, date: str) -> bytes:
    """Record of one page; ``holder``: (page id,) of the response that holds the payload, None if this one does."""
    headers = [
        ("WARC-Type", "revisit" if holder else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, copy)),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if holder:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(holder[0], digest))]
        if holder[0] is not None:
            headers.append(("X-Refers-To-Page", str(holder[0])))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return record(headers, http if holder else http + payload)


def info_record(name: str, date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name)), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], block)


# ---- writing

class _Roller:
    """Files of one shard, written under temporary names; ``done`` lists the closed ones."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, date: str):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.shard, self.roll_bytes, self.date = shard, roll_bytes, date
        self.attempt, self.seq, self.out, self.done = uuid.uuid4().hex, 0, None, []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.name, self.temp = f"shard-{self.shard:06d}-{self.seq:05d}.warc.gz", f"_temporary/{self.attempt}"
            self.fs.create_dir(f"{self.root}/{self.temp}", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.root}/{self.temp}/{self.name}", compression=None)
            self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
            self._put(info_record(self.name, self.date))
        self._put(member)
        self.records += 1
        if self.bytes >= self.roll_bytes:
            self.close()

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.sha.update(member)
        self.bytes += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.seq, f"{self.temp}/{self.name}", self.name, self.records, self.bytes, self.sha.hexdigest()))
            self.seq, self.out = self.seq + 1, None


def _file_rows(done: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [f.split()[0] for f in FILES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)


def _shard_writer(folder: str, roll_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, key, note, copy = None, None, None, 0
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                shard, page_id, digest, kind, holder, url, html = row
                if key != (page_id, digest):
                    key, note, copy = (page_id, digest), None, 0
                if kind == 0:
                    note = (holder,)
                    continue
                if roller is None or roller.shard != shard:
                    if roller is not None:
                        roller.close()
                        yield _file_rows(roller.done)
                    roller = _Roller(folder, shard, roll_bytes, date)
                held_here = note is None or (note[0] == page_id and copy == 0)
                roller.add(page_record(page_id, url, html, digest, None if held_here else note, copy, date))
                copy += 1
        if roller is not None:
            roller.close()
            yield _file_rows(roller.done)

    return write


def _rename(folder: str):
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for temp, name, size in zip(*[batch.column(c).to_pylist() for c in ("temp", "name", "bytes")]):
                if files.get_file_info(f"{root}/{temp}").type != pafs.FileType.NotFound:
                    files.move(f"{root}/{temp}", f"{root}/{name}")
                elif files.get_file_info(f"{root}/{name}").size != size:
                    raise FileNotFoundError(f"{folder}/{temp}")
            yield batch

    return rename


def shard_bounds(ids: DataFrame, shards: int, rows: int) -> np.ndarray:
    """The page ids that begin the second and later shards: exact ranks, so the same for the same rows."""
    if shards < 2:
        return np.empty(0, np.int64)
    step = -(-rows // shards)
    first = ranked(ids, "page_id").filter((F.col("rank") % step == 0) & (F.col("rank") > 0) & F.col("page_id").isNotNull())
    return np.unique(np.array([r["page_id"] for r in first.select("page_id").collect()], np.int64))


def write_archive(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, shard_bytes: int | None = None, date: str = DATE) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC files into ``folder``; returns the manifest."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(html, 256).alias("digest"), "url", html.alias("html"))
    ids = write_table(page.select("page_id", "digest", F.octet_length("html").alias("size")), "payloads")
    rows, total = ids.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    shard_bytes = shard_bytes or min(max(total // 4096, SHARD_BYTES[0]), SHARD_BYTES[1])
    shards = max(1, -(-total // shard_bytes))
    bounds = shard_bounds(ids.select("page_id"), shards, rows)

    place = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id")
    holders = ids.filter(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    holders = write_table(holders.filter("n > 1").select("digest", F.col("first.page_id").alias("holder")), "holders")
    notes = ids.select("page_id", "digest").join(small_side(holders, 120), "digest").distinct()

    @F.arrow_udf("int")
    def shard(page_ids: pa.Array) -> pa.Array:
        known = page_ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(bounds, known, side="right").astype(np.int32))

    none = F.lit(None)
    stream = page.select("page_id", "digest", F.lit(1).alias("kind"), none.cast("long").alias("holder"), "url", "html").unionByName(
        notes.select("page_id", "digest", F.lit(0).alias("kind"), "holder", none.cast("string").alias("url"), none.cast("binary").alias("html"))
    )
    dealt = (
        stream.select(shard("page_id").alias("shard"), "*")
        .repartitionById(len(bounds) + 1, F.col("shard"))
        .sortWithinPartitions("shard", "page_id", "digest", "kind")
    )
    written = write_table(dealt.mapInArrow(_shard_writer(folder, roll_bytes, date), FILES), "warc_files")
    written.mapInArrow(_rename(folder), FILES).write.mode("overwrite").parquet(f"{folder}/_manifest")
    for done in (ids, holders):
        drop_table(done)
    temp = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_temporary")
    temp.getFileSystem(spark._jsc.hadoopConfiguration()).delete(temp, True)
    return spark.read.schema(FILES).parquet(f"{folder}/_manifest")


# ---- reading

def members(stream) -> Iterator[tuple[bytes, bytes]]:
    """(uncompressed record, compressed bytes) of each gzip member, reading a bounded piece at a time."""
    rest = b""
    while True:
        plain, zipped, inflate = [], [], zlib.decompressobj(31)
        while not inflate.eof:
            piece = rest or stream.read(READ_BYTES)
            rest = b""
            if not piece:
                if zipped:
                    raise EOFError("truncated member")
                return
            plain.append(inflate.decompress(piece))
            rest = inflate.unused_data
            zipped.append(piece[: len(piece) - len(rest)])
        yield b"".join(plain), b"".join(zipped)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, block = raw.partition(CRLF * 2)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    if block[size:] != CRLF * 2 or f"sha256:{hashlib.sha256(block[:size]).hexdigest()}" != headers["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
    return headers, block[:size]


def _page_row(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    payload, digest = None, headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if headers["WARC-Type"] == "response":
        payload = block.partition(CRLF * 2)[2]
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"damaged payload {headers['WARC-Record-ID']}")
        size = len(payload)
    else:
        size = int(headers["X-Payload-Length"])
    number = lambda name: int(headers[name]) if name in headers else None
    return number("X-Page-ID"), headers.get("WARC-Target-URI"), size, digest, headers["WARC-Type"], number("X-Refers-To-Page"), payload if with_payload else None


def _page_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [f.split()[0] for f in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def read_archive(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The page records of the files in the manifest, checked against their digests (columns: RECORDS)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, sha in zip(batch.column("name").to_pylist(), batch.column("sha256").to_pylist()):
                whole, rows, held = hashlib.sha256(), [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for raw, zipped in members(stream):
                        whole.update(zipped)
                        headers, block = parse_record(raw)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(_page_row(headers, block, with_payload))
                        held += len(rows[-1][-1] or b"") + 200
                        if held > READ_BYTES:
                            yield _page_rows(rows)
                            rows, held = [], 0
                if rows:
                    yield _page_rows(rows)
                if whole.hexdigest() != sha:
                    raise ValueError(f"damaged file {name}")

    manifest = spark.read.schema(FILES).parquet(f"{folder}/_manifest").select("name", "sha256")
    files = max(1, manifest.count())
    return manifest.repartition(min(files, 100_000)).mapInArrow(read, RECORDS)


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` into a new folder of the shared folder and read the records back, without their payloads."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_archive(pages, folder, **options)
    return read_archive(spark, folder, with_payload=False).drop("url", "payload")
