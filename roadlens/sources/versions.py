"""Small published files that name the current state of a table in a shared folder.

A version is a file ``<number>.json`` that appears whole or not at all (written
under another name, then renamed).  The highest number is current.  A number
can be published once, so a replayed step that finds its number does nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published numbers, ascending."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))


def load_version(spark: SparkSession, path: str, number: int) -> dict:
    fs, p = _folder(spark, f"{path}/{number:020d}.json")
    jvm = spark._jvm
    stream = fs.open(p)
    try:
        return json.loads(jvm.java.lang.String(stream.readAllBytes(), "UTF-8"))
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    found = versions(spark, path)
    return (found[-1], load_version(spark, path, found[-1])) if found else None


def publish(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Make ``content`` version ``number``; an error if that number exists."""
    fs, p = _folder(spark, path)
    fs.mkdirs(p)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    if number in versions(spark, path):
        raise RuntimeError(f"version {number} of {path} is already published")
    temp = path_of(f"{path}/_{uuid.uuid4().hex}")
    out = fs.create(temp, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    if not fs.rename(temp, path_of(f"{path}/{number:020d}.json")):
        raise RuntimeError(f"could not publish version {number} of {path}")


def forget(spark: SparkSession, path: str, before: int) -> None:
    """Delete the versions below ``before``."""
    fs, _ = _folder(spark, path)
    for number in versions(spark, path):
        if number < before:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{number:020d}.json"), False)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)
