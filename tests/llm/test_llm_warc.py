"""WARC archives: exact round trip, determinism, rolling, revisits, damage."""

from __future__ import annotations

import gzip
import hashlib
import os
import random
import uuid

import pytest
from roadlens.llm import warc as W

SCHEMA = "page_id long, url string, html string"


def pages():
    rng = random.Random(9)
    rows = [(i, f"http://a.net/{i}", "<p>" + "".join(rng.choice("abcé日 \r\n") for _ in range(rng.randrange(0, 400))) + "</p>") for i in range(80)]
    same = "<html>" + "same " * 40 + "</html>"
    rows += [(100 + i, "http://b.net/", same) for i in range(30)] + [(200, None, "tiny"), (201, "http://c.net/a\r\nb", "tiny"), (202, "", None), (203, "u", "")]
    rows += [(None, "n", same), (None, "n", "x" * 150), (None, "n", "x" * 150), (100, "http://b.net/", same), (300, "u", "y" * 100), (300, "u", "y" * 100), (301, "u", "z" * 99), (302, "u", "z" * 99)]
    return rows


def folder(tmp_path):
    return f"{tmp_path}/{uuid.uuid4().hex}"


def expected(rows):
    payload = lambda h: (h or "").encode()
    first, seen, out = {}, set(), []
    for i, _, h in rows:
        if i is not None:
            first[payload(h)] = min(first.get(payload(h), i), i)
    for i, _, h in rows:
        p = payload(h)
        holder = first.get(p)
        held = len(p) < 100 or (holder == i and (p, i) not in seen)
        seen.add((p, i))
        out.append((str(i), len(p), hashlib.sha256(p).hexdigest(), "response" if held else "revisit", str(None if held else holder)))
    return sorted(out)


def key(df):
    return sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in df.collect())


def test_round_trip_is_exact(spark, tmp_path):
    rows, at = pages(), folder(tmp_path)
    manifest = W.write_archive(spark.createDataFrame(rows, SCHEMA).repartition(5), at, shard_bytes=4000)
    got = W.read_archive(spark, at)
    assert key(got) == expected(rows)
    bodies = {r.payload_digest: bytes(r.payload) for r in got.collect() if r.record_type == "response"}
    assert all(bodies[hashlib.sha256((h or "").encode()).hexdigest()] == (h or "").encode() for _, _, h in rows)
    assert {r.url for r in got.collect() if r.page_id in (200, 201)} == {None, "http://c.net/a%0D%0Ab"}
    listed = {r.name for r in manifest.collect()}
    assert len({r.shard for r in manifest.collect()}) > 3 and {f for f in os.listdir(at) if f.endswith(".gz")} == listed and not os.path.exists(f"{at}/_temporary")
    for name in listed:  # any gzip reader sees one whole file of WARC records
        assert gzip.open(f"{at}/{name}").read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_same_rows_make_the_same_files(spark, tmp_path):
    df = spark.createDataFrame(pages(), SCHEMA)
    runs = [W.write_archive(df.repartition(n), folder(tmp_path), shard_bytes=5000, roll_bytes=1500) for n in (2, 7)]
    files = [sorted((r.name, r.records, r.bytes, r.sha256) for r in run.collect()) for run in runs]
    assert files[0] == files[1] and max(r.seq for r in runs[0].collect()) > 0


def test_files_roll_by_compressed_size(spark, tmp_path):
    at = folder(tmp_path)
    manifest = W.write_archive(spark.createDataFrame(pages(), SCHEMA), at, roll_bytes=2000).collect()
    assert len(manifest) > 3 and all(r.bytes >= 2000 for r in manifest if r.seq < max(m.seq for m in manifest))
    assert key(W.read_archive(spark, at)) == expected(pages())


def test_damage_is_found(spark, tmp_path):
    at = folder(tmp_path)
    name = W.write_archive(spark.createDataFrame(pages(), SCHEMA), at).first().name
    raw = bytearray(open(f"{at}/{name}", "rb").read())
    raw[len(raw) // 2] ^= 0xFF
    open(f"{at}/{name}", "wb").write(bytes(raw))
    with pytest.raises(Exception):
        W.read_archive(spark, at).collect()


def test_renaming_again_is_harmless_and_lost_files_are_noticed(spark, tmp_path):
    at = folder(tmp_path)
    manifest = W.write_archive(spark.createDataFrame(pages(), SCHEMA), at)
    again = manifest.mapInArrow(W._rename(at), W.FILES)
    assert again.count() == manifest.count()
    os.remove(f"{at}/{manifest.first().name}")
    with pytest.raises(Exception):
        again.count()


def test_empty_table_and_other_columns(spark, tmp_path):
    at = folder(tmp_path)
    W.write_archive(spark.createDataFrame([], SCHEMA), at)
    assert W.read_archive(spark, at).collect() == []
    df = spark.createDataFrame([(1, "u", "h", 5, "d")], SCHEMA + ", shard int, digest string")
    assert [r.record_type for r in W.archive_round_trip(df).collect()] == ["response"]
