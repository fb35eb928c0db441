"""Benchmark decontamination: a broadcast set of normalised test windows, scanned over whole texts.

A window is ``WINDOW`` consecutive words of an item (all words of a shorter
item).  The windows are hashed over word numbers; a text is scanned with a
rolling hash over its own word numbers, and every hash hit is verified word
by word, so hash collisions never count.

The window set is arrays: the items' word numbers in one line, per window
length the sorted hashes, one place of each window in the line, and the items
that have it.  It takes some twenty bytes a window beside the vocabulary.  It
is broadcast in blocks of items of bounded size: one block for a usual
benchmark.  A huge one takes several scans of ``BLOCKS_PER_SCAN`` blocks; what
a scan found is written with its rows before the next one, and that table goes
when the next is written, so a task never holds more than one scan's blocks.
Texts are never shuffled; a very long one becomes words a piece at a time.

Edge cases: null and word-free texts have no words and are clean.  Items
without a word are ignored; items with equal windows all count; rows that
repeat an item id count as one item.  A null item id names no item: its
windows mark words but it is not listed.  An empty benchmark leaves all
clean.  Repeated rows and other columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_TABLE, drop_table, write_table

WINDOW = 13
#: In UTF-8, characters above 0x7F are the bytes above 0x7F.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Bytes of a text that are turned into words at once.
PIECE_BYTES = 1 << 20
#: Hits that are verified at once.
STEP = 1 << 16
#: Bytes of item text in one broadcast window set (which takes some ten times as much).
BLOCK_BYTES = 4 << 20
BLOCKS_PER_SCAN = 4
BASE = 0x9E3779B97F4A7C15
ABSENT = -1


def word_lists(text: bytes | None) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, a piece of about ``PIECE_BYTES`` at a time (longer only by one word)."""
    at, text = 0, text or b""
    while at < len(text):
        end = at + PIECE_BYTES
        if end < len(text):
            gap = GAP.search(text, end)
            end = gap.start() if gap else len(text)
        yield WORD.findall(text[at:end].translate(LOWER_TABLE))
        at = end


def rolling(numbers: np.ndarray, length: int, base: int = BASE) -> np.ndarray:
    """Polynomial hash of every run of ``length`` word numbers (64-bit arithmetic that wraps around)."""
    n = len(numbers) - length + 1
    out = np.zeros(max(n, 0), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            out *= np.uint64(base)
            out += numbers[i : i + n].astype(np.uint64) + np.uint64(1)
    return out


def _windows(line: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    return line[starts[:, None] + np.arange(size)]


@dataclass(frozen=True)
class Windows:
    """The windows of one length: ``hashes`` sorted, one ``place`` of each in the line, ``owners[edges[i]:edges[i + 1]]`` its items."""

    hashes: np.ndarray
    place: np.ndarray
    edges: np.ndarray
    owners: np.ndarray


@dataclass(frozen=True)
class WindowSet:
    """``numbers``: word -> number; ``line``: all items' word numbers; ``windows`` by length; ``items``: the ids."""

    numbers: dict[bytes, int]
    line: np.ndarray
    windows: dict[int, Windows]
    items: list
    base: int

    @classmethod
    def build(cls, rows: list[tuple], length: int, base: int = BASE) -> "WindowSet":
        numbers: dict[bytes, int] = {}
        ids: dict = {}
        lines, starts, owners, at = [], {}, {}, 0
        for item, text in rows:
            found = [numbers.setdefault(w, len(numbers)) for part in word_lists(text) for w in part]
            size = min(length, len(found))
            if size:
                lines.append(np.array(found, np.int32))
                n = len(found) - size + 1
                starts.setdefault(size, []).append(at + np.arange(n))
                owners.setdefault(size, []).append(np.full(n, ids.setdefault(item, len(ids)), np.int32))
                at += len(found)
        line = np.concatenate(lines) if lines else np.empty(0, np.int32)
        windows = {}
        for size in starts:
            place, owner = np.concatenate(starts[size]), np.concatenate(owners[size])
            digest = rolling(line, size, base)[place]
            order = np.lexsort((owner, digest))
            place, owner, digest = place[order], owner[order], digest[order]
            new = np.concatenate(([True], digest[1:] != digest[:-1]))
            first = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            for lo in range(0, len(place), STEP):
                some = slice(lo, lo + STEP)
                if (_windows(line, place[some], size) != _windows(line, place[first[group[some]]], size)).any():
                    return cls.build(rows, length, base + 2)  # two windows of one hash: another factor tells them apart
            distinct = new | np.concatenate(([True], owner[1:] != owner[:-1]))
            edges = np.searchsorted(group[distinct], np.arange(len(first) + 1))
            windows[size] = Windows(digest[first], place[first], edges, owner[distinct])
        return cls(numbers, line, windows, list(ids), base)

    def scan(self, text: bytes | None) -> tuple[int, np.ndarray, set]:
        """(number of words, sorted positions of hit words, item ids that occur)."""
        number = self.numbers.get
        parts = [np.fromiter((number(w, ABSENT) for w in part), np.int32, len(part)) for part in word_lists(text)]
        line = np.concatenate(parts) if parts else np.empty(0, np.int32)
        n = len(line)
        known = np.concatenate(([0], np.cumsum(line != ABSENT)))
        marks, seen = np.zeros(n + 1, np.int32), set()
        for size, table in self.windows.items():
            if n < size:
                continue
            # windows of known words only; the rest cannot be in the set
            starts = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(starts):
                continue
            digest = rolling(line, size, self.base)[starts]
            at = np.minimum(np.searchsorted(table.hashes, digest), len(table.hashes) - 1)
            hit = np.flatnonzero(table.hashes[at] == digest)
            for lo in range(0, len(hit), STEP):
                some = hit[lo : lo + STEP]
                same = (_windows(line, starts[some], size) == _windows(self.line, table.place[at[some]], size)).all(axis=1)
                some = some[same]
                np.add.at(marks, starts[some], 1)
                np.add.at(marks, starts[some] + size, -1)
                for w in np.unique(at[some]).tolist():
                    seen.update(self.items[i] for i in table.owners[table.edges[w] : table.edges[w + 1]].tolist())
        return n, np.flatnonzero(np.cumsum(marks[:n])), seen


def window_blocks(benchmark: DataFrame, window: int, block_bytes: int = BLOCK_BYTES) -> Iterator[WindowSet]:
    """Window sets over blocks of whole items, of about half of ``block_bytes`` of item text (or one item), one at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).filter("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // max(1, block_bytes // 2)))
    for i in range(n):
        block = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield WindowSet.build([(r["item"], bytes(r["text"])) for r in block.collect()], window)


def scanner(docs: DataFrame, windows: WindowSet):
    """Arrow function: text -> struct(n_words, hits: positions of hit words, items)."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    @F.arrow_udf("n_words long, hits array<int>, items array<string>")
    def scan(texts: pa.Array) -> pa.Array:
        found = [shared.value.scan(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32())),
                pa.array([sorted(i for i in f[2] if i is not None) for f in found], pa.list_(pa.string())),
            ],
            ["n_words", "hits", "items"],
        )

    return scan


def scanned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, n_words, hits, items): every row of ``docs`` with its hit word positions and the items found."""
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    parts, written = [], None
    for i, block in enumerate(window_blocks(benchmark, window, block_bytes)):
        if i and i % BLOCKS_PER_SCAN == 0:
            out = write_table(out, "scanned")
            if written is not None:
                drop_table(written)
            written = out
        parts.append(f"s{i}")
        out = out.withColumn(parts[-1], scanner(docs, block)(F.col("row.text").cast("binary")))
    join = lambda field: F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{p}.{field}") for p in parts]))))
    return out.select("row", F.col(f"{parts[0]}.n_words").alias("n_words"), join("hits").alias("hits"), join("items").alias("items"))


def is_contaminated() -> F.Column:
    hit = F.size("hits")
    return (hit > 0) & (20 * hit >= F.col("n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return scanned(docs.select("doc_id", "text"), benchmark, window).select(
        "row.doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The clean rows of ``docs``, all columns as they are."""
    return scanned(docs, benchmark, window).filter(~is_contaminated()).select("row.*")


def cut_spans(text: bytes, hits: list[int]) -> bytes:
    """``text`` without its hit words; what stood between words stays."""
    spans = [m.span() for m in WORD.finditer(text.translate(LOWER_TABLE))]
    out, at = [], 0
    for h in hits:
        out.append(text[at : spans[h][0]])
        at = spans[h][1]
    return b"".join([*out, text[at:]])


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows of ``docs`` with the hit words cut out of their texts (the gentler choice than dropping documents)."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, hits: pa.Array) -> pa.Array:
        return pa.array([None if t is None else cut_spans(t, h).decode() for t, h in zip(texts.to_pylist(), hits.to_pylist())], pa.string())

    found = scanned(docs, benchmark, window)
    text = F.when(F.size("hits") > 0, cut(F.col("row.text").cast("binary"), F.col("hits"))).otherwise(F.col("row.text"))
    return found.withColumn("row", F.col("row").withField("text", text)).select("row.*")
