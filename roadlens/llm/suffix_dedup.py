"""Removal of repeated byte strings: column-wise suffix order over the passages that could repeat.

A byte goes if a string of ``MIN_BYTES`` bytes that covers it starts anywhere
else in the collection.  The suffix order is built for many strings at once,
column by column from the right: each round puts one symbol in front of every
string, and the order, the column of symbols in that order (the collection's
Burrows-Wheeler transform) and the common prefixes of neighbours follow from
the round before.  Two suffixes repeat if a neighbour shares ``MIN_BYTES``.

Rounds over whole documents would be as many as the longest text has bytes, so
the collection is cut where equal strings must be cut alike:

1. ``anchored_pieces``: a window of ``MIN_BYTES`` bytes is owned by the
   leftmost smallest hash of its ``CORE``-byte strings, its anchor.  Equal
   windows have equal anchors at the same distance.  The windows of one anchor
   are one piece of the text; one scan writes its place, core hash and content
   hash, no text.
2. ``live_pieces``: equal pieces are one string with a count; a core that occurs
   once anywhere is left out, as none of its windows can repeat.  Partial
   aggregates come before each shuffle, so copies send one row per task.
3. ``piece_texts``: only pieces that meet another piece with their core are
   fetched as bytes, each once, from the text of one row that has it.
4. ``repeated_windows``: pieces of one core are aligned at their anchor; their
   columns are the rounds (at most ``2 * MIN_BYTES``).  Windows of equal pieces
   repeat by their count.
5. A core with more than ``CROWD`` different pieces (a passage that very many
   texts share, each going on in its own way) does not go to one task: its
   windows are cut into cells of 64, 16, 4 and at last one neighbour, each with a
   longer core: pieces that differ fall apart, equal ones become one, and only
   cells that are still crowded are cut again.
6. Repeated windows are spans; the spans of a text are merged, and the texts
   that keep some of their bytes are read once more for the digest.

Equality of pieces rests on 128-bit hashes, that of windows in different
pieces on their bytes.  Texts are read in slices of ``SLICE`` bytes, so memory
does not grow with a text but for its own bytes.

Defined results: null texts are empty, texts shorter than ``MIN_BYTES`` keep
everything, rows that repeat an id or all columns are texts of their own (and
copies of each other), null ids are kept.  An empty table gives no rows.  Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table

#: Shortest repeat, in bytes.
MIN_BYTES = 400
#: Bytes of an anchor, a power of two.
CORE = 128
#: Window starts of one vector step.
SLICE = 1 << 20
#: Pieces of one suffix order.
GROUP = 8192
#: More different pieces than this with one core are cut into cells.
CROWD = 1_000
#: Neighbouring windows per cell, from cut to cut; windows alone cannot crowd.
CELLS = (64, 16, 4, 1)

#: Low bits of an ordering key that hold the place (leftmost wins); a power of two above ``SLICE`` and its overhang.
PLACE = np.uint64((1 << 24) - 1)
#: An odd factor without structure (2**64 divided by the golden ratio).
FACTOR = 0x9E3779B97F4A7C15
KEY = ["core", "h1", "h2"]
SPANS = "array<struct<start:long,stop:long>>"


def core_hashes(buffer: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes (a power of two) at every place."""
    h = buffer.astype(np.uint64) + np.uint64(1)
    length, factor = 1, FACTOR
    while length < size:
        h = h[:-length] * np.uint64(factor) + h[length:]
        length, factor = 2 * length, factor * factor % 2**64
    h ^= h >> np.uint64(31)
    h *= np.uint64(FACTOR)
    h ^= h >> np.uint64(29)
    return h


def anchors(hashes: np.ndarray, count: int) -> np.ndarray:
    """For every place, that of the leftmost smallest of the ``count`` hashes from there on."""
    low = hashes & ~PLACE | np.arange(len(hashes), dtype=np.uint64)
    length = 1
    while 2 * length <= count:
        low = np.minimum(low[:-length], low[length:])
        length *= 2
    if length < count:
        low = np.minimum(low[: len(low) - (count - length)], low[count - length :])
    return (low & PLACE).astype(np.int64)


def merged(starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals sorted by owner and start; those that touch are one."""
    if not len(starts):
        return starts, ends, owner
    new = np.concatenate(([True], owner[1:] != owner[:-1]))
    base = owner * (np.int64(1) << 40)  # far apart, so the running maximum does not cross owners
    reach = np.maximum.accumulate(ends + base)
    new[1:] |= starts[1:] + base[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return starts[first], np.maximum.reduceat(ends, first), owner[first]


def _pieces_of(parts: list[tuple[int, int, bytes]]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Pieces and the spans repeated within one part, of (row, offset, bytes) parts that are scanned together."""
    raw = b"".join(p[2] for p in parts)
    sizes = np.array([len(p[2]) for p in parts])
    ends = np.cumsum(sizes)
    windows = MIN_BYTES - CORE + 1
    buffer = np.frombuffer(raw, np.uint8)
    hashes = core_hashes(buffer, CORE)
    anchor = anchors(hashes, windows)
    part = np.repeat(np.arange(len(parts)), sizes)[: len(anchor)]
    at = np.flatnonzero(np.arange(len(anchor)) + MIN_BYTES <= ends[part])
    own = anchor[at]
    first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)))) if len(at) else at
    last = np.append(first[1:], len(at)) - 1 if len(at) else at
    start, stop, place = at[first], at[last] + MIN_BYTES, own[first]
    lead, part = place - start, part[start]
    view = memoryview(raw)
    digest = xxhash.xxh3_128_digest
    found = b"".join(digest(view[a:b], k) for a, b, k in zip(start.tolist(), stop.tolist(), lead.tolist()))
    h = np.frombuffer(found, np.int64).reshape(-1, 2)
    # equal pieces of one part repeat each other: one row with their number, and their bytes as spans
    order = np.lexsort((start, h[:, 1], h[:, 0], part))
    same = np.concatenate(([True], (part[order][1:] != part[order][:-1]) | (h[order][1:] != h[order][:-1]).any(axis=1))) if len(order) else np.zeros(0, bool)
    head = np.flatnonzero(same)
    many = np.diff(np.append(head, len(order)))
    keep = order[head]
    base = ends - sizes
    row = np.array([p[0] for p in parts])
    offset = np.array([p[1] for p in parts]) - base
    pieces = {
        "row_no": row[part[keep]],
        "core": hashes[place[keep]].view(np.int64),
        "h1": h[keep, 0],
        "h2": h[keep, 1],
        "start": start[keep] + offset[part[keep]],
        "lead": lead[keep],
        "size": stop[keep] - start[keep],
        "n": many,
    }
    again = np.sort(order[np.repeat(many > 1, many)])
    a, b, who = merged(start[again], stop[again], part[again])
    return pieces, {"row_no": row[who], "start": a + offset[who], "stop": b + offset[who]}


SCAN = {"kind": "int", "row_no": "long", "doc_id": None, "digest": "binary", "core": "long", "h1": "long", "h2": "long", "start": "long", "stop": "long", "lead": "int", "size": "int", "n": "long"}
ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of three kinds: 0 the text itself (its bytes in ``stop``), 1 a piece, 2 a span that repeats within a part of a text."""
    id_type = pa.null()

    def emit(kind: int, columns: dict) -> pa.RecordBatch:
        n = len(columns["row_no"])
        columns = {"kind": np.full(n, kind), **columns}
        types = {c: ARROW.get(t, id_type) for c, t in SCAN.items()}
        return pa.RecordBatch.from_arrays([pa.array(columns[c]).cast(t) if c in columns else pa.nulls(n, t) for c, t in types.items()], names=list(types))

    def flush(parts: list) -> Iterator[pa.RecordBatch]:
        if sum(len(p[2]) for p in parts) >= MIN_BYTES:
            pieces, spans = _pieces_of(parts)
            for kind, found in ((1, pieces), (2, spans)):
                if len(found["row_no"]):
                    yield emit(kind, found)

    parts, held = [], 0
    for batch in batches:
        id_type = batch["doc_id"].type
        yield emit(0, {"row_no": batch["row_no"], "doc_id": batch["doc_id"], "digest": batch["digest"], "stop": batch["size"]})
        for row, text in zip(batch["row_no"].to_pylist(), batch["text"]):
            raw = text.as_buffer()
            for offset in range(0, len(raw) - MIN_BYTES + 1, SLICE):
                parts.append((row, offset, raw.slice(offset, min(SLICE + MIN_BYTES - 1, len(raw) - offset)).to_pybytes()))
                held += len(parts[-1][2])
                if held >= SLICE:
                    yield from flush(parts)
                    parts, held = [], 0
    yield from flush(parts)


def anchored_pieces(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, pieces, spans) of a written table: one scan of ``docs(doc_id, text)``."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("size"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = write_table(rows.mapInArrow(_scan, ", ".join(f"{c} {t or id_type}" for c, t in SCAN.items())), "anchored")
    texts = found.filter("kind = 0").select("row_no", "doc_id", "digest", F.col("stop").alias("n_bytes"))
    pieces = found.filter("kind = 1").select("row_no", *KEY, "start", "lead", "size", "n")
    return texts, pieces, found.filter("kind = 2").select("row_no", "start", "stop")


def counted(pieces: DataFrame) -> DataFrame:
    """``pieces(core, h1, h2, n, ...)`` of cores that occur more than once, with ``kinds``: how many different pieces the core has.

    Both sides of the join are plain tables, so Spark can split a core with very many pieces.
    """
    cores = pieces.groupBy("core").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds")).filter("all > 1")
    cores = write_table(cores.select(F.col("core").alias("c"), "kinds"), "cores")
    return pieces.join(cores, F.col("core") == F.col("c")).drop("c")


def live_pieces(pieces: DataFrame) -> DataFrame:
    """Written table of the different pieces whose core repeats: count, one place (row, start), shape and ``kinds``."""
    same = pieces.groupBy(*KEY).agg(
        F.sum("n").alias("n"), F.min(F.struct("row_no", "start")).alias("at"), F.first("lead").alias("lead"), F.first("size").alias("size")
    )
    return write_table(counted(write_table(same, "pieces")), "live_pieces")


def piece_texts(docs: DataFrame, texts: DataFrame, live: DataFrame) -> DataFrame:
    """Written ``live`` pieces that meet another one, with their bytes (``body``)."""
    wanted = live.filter("kinds > 1").groupBy(F.col("at.row_no").alias("row_no")).agg(F.collect_list(F.struct(*KEY, "n", "lead", "size", "kinds", F.col("at.start").alias("start"))).alias("wanted"))
    wanted = wanted.join(texts.select("row_no", F.col("doc_id").alias("own_id"), F.col("digest").alias("own_digest")), "row_no")
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", body.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    met = rows.join(wanted, (F.col("digest") == F.col("own_digest")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
    out = met.select("text", F.explode("wanted").alias("w")).select("w.*", F.substring("text", F.col("w.start").cast("int") + 1, F.col("w.size")).alias("body"))
    return write_table(out.drop("start"), "piece_texts")


def repeats_among(core: np.ndarray, lead: np.ndarray, bodies: list[bytes], count: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per piece, the repeated windows as (first, last) offsets.  Pieces are sorted by core and different within it.

    Rounds go over the columns from the right; ``order`` holds the pieces of
    each core in suffix order, ``common[k]`` what the k-th shares with the one
    before it.
    """
    n = len(core)
    size = np.array([len(b) for b in bodies])
    left, right = int(lead.max()), int((size - lead).max())
    columns = np.zeros((left + right, n), np.uint16)  # 0: outside the piece
    for i, b in enumerate(bodies):
        at = left - lead[i]
        columns[at : at + len(b), i] = np.frombuffer(b, np.uint8).astype(np.uint16) + 1
    group = np.cumsum(np.concatenate(([0], core[1:] != core[:-1]))).astype(np.int64) << 9
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)
    marks = np.zeros((int((size - MIN_BYTES).max()) + 1, n), bool)
    offset = lead - left  # of a column, within a piece: its number plus this
    marks[:, count > 1] = True
    for column in range(left + right - 1, -1, -1):
        symbol = columns[column][order]
        key = group[order] + symbol
        if (key[1:] >= key[:-1]).all():
            same = (key[1:] == key[:-1]) & (symbol[1:] > 0)
            common[1:-1] = np.where(same, common[1:-1] + 1, 0)
        else:
            place = np.argsort(key, kind="stable")
            key, symbol = key[place], symbol[place]
            same = np.flatnonzero((key[1:] == key[:-1]) & (symbol[1:] > 0)) + 1
            # the least common prefix between the former places of two neighbours
            a, b = place[same - 1] + 1, place[same] + 1
            low = common[a].copy()
            far = np.flatnonzero(b > a + 1)
            if len(far):
                low[far] = np.minimum.reduceat(common, np.stack([a[far], b[far]], axis=1).reshape(-1))[::2]
            common = np.zeros(n + 1, np.int32)
            common[same] = low + 1
            order = order[place]
        if column + MIN_BYTES <= left + right:
            long = common >= MIN_BYTES
            if long.any():
                hit = order[long[:-1] | long[1:]]
                marks[column + offset[hit], hit] = True
    marks &= np.arange(len(marks))[:, None] <= (size - MIN_BYTES)[None, :]
    out = []
    for own in np.ascontiguousarray(marks.T):
        edge = np.diff(np.concatenate(([0], own.view(np.int8), [0])))
        out.append((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1))
    return out


def _order_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole cores at a time, about ``GROUP`` pieces together."""

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        key = np.stack([np.asarray(rows[c]) for c in KEY])
        new = np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0))))  # a row read twice is one piece
        rows = rows.take(pa.array(new))
        core, h1, h2 = key[:, new]
        found = repeats_among(core, np.asarray(rows["lead"]), rows["body"].to_pylist(), np.asarray(rows["n"]))
        many = np.array([len(f[0]) for f in found])
        columns = [np.repeat(c, many) for c in (core, h1, h2)] + [np.concatenate([f[k] for f in found]).astype(np.int32) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*KEY, "first", "last"])

    held, count = [], 0
    for batch in batches:
        core = np.asarray(batch["core"])
        starts = np.flatnonzero(core[1:] != core[:-1]) + 1
        if held and len(core) and held[-1]["core"][-1].as_py() != core[0]:
            starts = np.append(0, starts)
        if len(starts) and count + starts[-1] >= GROUP:
            yield solve([*held, batch.slice(0, starts[-1])])
            batch, held, count = batch.slice(starts[-1]), [], 0
        if batch.num_rows:
            held.append(batch)
            count += batch.num_rows
    if held:
        yield solve(held)


def _cells(width: int):
    """Pieces cut into the parts of ``width`` neighbouring windows (by distance from the anchor), each with the bytes its windows share as core."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for core, h1, h2, n, lead, body in zip(*(batch[c].to_pylist() for c in (*KEY, "n", "lead", "body"))):
                last = len(body) - MIN_BYTES
                w = 0
                while w <= last:
                    cell = (lead - w) // width  # windows w .. e have their distance lead - w in this cell
                    e = min(last, lead - cell * width)
                    shared = lead - cell * width  # the cell's last window; its first begins width - 1 earlier
                    own = body[w : e + MIN_BYTES]
                    middle = body[shared : shared - (width - 1) + MIN_BYTES]
                    new = xxhash.xxh3_64_intdigest(middle, (core ^ cell) & 0xFFFFFFFFFFFFFFFF)
                    d = np.frombuffer(xxhash.xxh3_128_digest(own, lead - w), np.int64)
                    out.append((core, h1, h2, w, new - 2**64 if new >= 2**63 else new, int(d[0]), int(d[1]), n, lead - w, own))
                    w = e + 1
            names = ["core", "h1", "h2", "shift", "core2", "h12", "h22", "n", "lead", "body"]
            types = [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 4 + [pa.int32(), pa.binary()]
            for i in range(0, len(out), GROUP):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + GROUP]), types)], names=names)

    return run


def repeated_windows(bodies: DataFrame, crowd: int = CROWD, cells: tuple = CELLS) -> DataFrame:
    """(core, h1, h2, first, last): the repeated windows of ``bodies(core, h1, h2, n, lead, kinds, body)``."""
    shape = "core long, h1 long, h2 long, first int, last int"
    few = bodies.filter(F.col("kinds") <= crowd) if cells else bodies
    dealt = few.select(*KEY, "n", "lead", "body").repartition("core").sortWithinPartitions(*KEY)
    found = dealt.mapInArrow(_order_pieces, shape)
    if not cells or bodies.agg(F.max("kinds")).first()[0] in (None, *range(crowd + 1)):
        return found
    many = bodies.filter(F.col("kinds") > crowd).select(*KEY, "n", "lead", "body")
    cut = "core long, h1 long, h2 long, shift int, core2 long, h12 long, h22 long, n long, lead int, body binary"
    parts = write_table(many.mapInArrow(_cells(cells[0]), cut), "cells")
    renamed = parts.select(F.col("core2").alias("core"), F.col("h12").alias("h1"), F.col("h22").alias("h2"), "n", "lead", "body")
    same = renamed.groupBy(*KEY).agg(F.sum("n").alias("n"), F.first("lead").alias("lead"), F.first("body").alias("body"))
    again = write_table(counted(write_table(same, "cell_pieces")), "live_cells")
    inner = again.filter("kinds > 1")
    whole = again.filter("kinds = 1").select(*KEY, F.lit(0).alias("first"), (F.octet_length("body") - MIN_BYTES).alias("last"))
    hits = whole.union(repeated_windows(inner, crowd, cells[1:]))
    hits = write_table(hits.select(F.col("core").alias("core2"), F.col("h1").alias("h12"), F.col("h2").alias("h22"), "first", "last"), "cell_hits")
    back = parts.select(*KEY, "shift", "core2", "h12", "h22").join(hits, ["core2", "h12", "h22"])
    return found.union(back.select(*KEY, F.col("first") + F.col("shift"), F.col("last") + F.col("shift")))


def merge_spans(spans: pa.Array) -> pa.Array:
    """Sorted spans of each row, those that overlap or touch made one."""
    owner = np.repeat(np.arange(len(spans)), np.asarray(spans.value_lengths().fill_null(0)))
    flat = spans.flatten()
    start, stop, who = merged(np.asarray(flat.field("start")), np.asarray(flat.field("stop")), owner)
    edges = np.searchsorted(who, np.arange(len(spans) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays([pa.array(start), pa.array(stop)], ["start", "stop"]))


def kept_bytes(text: bytes, spans: list[dict]) -> Iterator[bytes]:
    at = 0
    for s in spans:
        yield text[at : s["start"]]
        at = s["stop"]
    yield text[at:]


def kept_digest(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, own in zip(texts, spans.to_pylist()):
        state = hashlib.sha256()
        for part in kept_bytes(memoryview(text.as_buffer()), own or []):
            state.update(part)
        out.append(state.hexdigest())
    return pa.array(out, pa.string())


def kept_text(texts: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array([b"".join(kept_bytes(memoryview(t.as_buffer()), own or [])) for t, own in zip(texts, spans.to_pylist())], pa.binary())


def repeated_spans(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Written table, one row per row of ``docs``: row_no, doc_id, digest, n_bytes, spans (merged, in order)."""
    texts, pieces, inside = anchored_pieces(docs)
    live = live_pieces(pieces)
    windows = repeated_windows(piece_texts(docs, texts, live), crowd)
    whole = live.filter("kinds = 1").select(*KEY, F.lit(0).alias("first"), (F.col("size") - MIN_BYTES).alias("last"))
    hits = write_table(whole.union(windows), "hits")
    spans = pieces.select("row_no", "start", *KEY).join(hits, KEY)
    spans = spans.select("row_no", (F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("last") + MIN_BYTES).alias("stop")).union(inside)
    spans = spans.groupBy("row_no").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    found = texts.join(spans.select("row_no", F.arrow_udf(merge_spans, SPANS)("spans").alias("spans")), "row_no", "left")
    return write_table(found.withColumn("spans", F.coalesce("spans", F.array().cast(SPANS))), "spans")


def _with_text(docs: DataFrame, named: DataFrame, *made) -> DataFrame:
    """``named(doc_id, digest, spans, ...)`` beside the columns ``made`` from the row's own text and spans."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").alias("own_id"), body.alias("body")).withColumn("own_digest", F.unhex(F.sha2("body", 256)))
    one = named.groupBy("doc_id", "digest").agg(F.first("spans").alias("spans"))  # equal rows have equal spans
    met = rows.join(one, (F.col("own_digest") == F.col("digest")) & F.col("own_id").eqNullSafe(F.col("doc_id")))
    return met.select("doc_id", F.octet_length("body").cast("long").alias("n_bytes"), "spans", *made)


def removed(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])


def repeat_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = repeated_spans(docs).withColumn("n_removed", removed())
    columns = ["doc_id", "n_bytes", removed().alias("n_removed"), F.size("spans").cast("long").alias("n_spans")]
    some = (F.col("n_removed") > 0) & (F.col("n_removed") < F.col("n_bytes"))
    plain = F.when(F.col("n_removed") == 0, F.lower(F.hex("digest"))).otherwise(F.lit(hashlib.sha256(b"").hexdigest()))
    cut = _with_text(docs, found.filter(some), F.arrow_udf(kept_digest, "string")("body", "spans").alias("kept_sha256"))
    return found.filter(~some).select(*columns, plain.alias("kept_sha256")).union(cut.select(*columns, "kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, kept): the bytes of every row's text that no repeat covers."""
    return _with_text(docs, repeated_spans(docs), F.arrow_udf(kept_text, "binary")("body", "spans").alias("kept")).select("doc_id", "kept")
