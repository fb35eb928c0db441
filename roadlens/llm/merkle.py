"""Merkle manifest of a table: a tree per group of rows and one over the groups, folded from kept SHA midstates.

A leaf is the digest of a row; every ``FAN`` consecutive nodes become the
digest of their hex digests, until one is left.  A digest of 64 hex digits
fills one block of SHA-256, so a parent can keep a copy of its hash state
before each child slot as 32 bytes of a table.  To put another leaf in, the
state of its slot resumes with the replacement and the siblings to its right
only; what lies to the left is not hashed again.

How it runs:

1. ``document_leaves``: one scan, digests by Spark's own functions, a narrow
   written table.  Texts are not read again.
2. ``ranked`` gives the place of every leaf in its group by a range sort; a
   group with a third of all rows spreads over as many tasks as its share.
3. Bands of ``BAND`` levels.  ``FAN ** BAND`` consecutive nodes of a group form
   a block; whole blocks are built in one task, so no key is larger than a
   block and 10^11 leaves need four bands.  The leaves are folded up to their
   block's root in the same task.
4. The few block roots go through further bands, and the roots of the groups
   form the last tree.  The paths above each block are put together on tables
   of one row per block, and one join by (group, block) brings each leaf its
   path, broadcast only if it fits the bound.  Folding goes on there.

Defined results: null fields have their own mark.  Rows that repeat an id are
separate leaves, ordered by digest; a null id comes first.  Null and empty
groups are different groups, null first.  A group of one row is its own
subroot, a single group's subroot is the root.  An empty table gives an empty
result.  Columns other than the named fields are not read.  Very long texts
are hashed by Spark as they lie; only digests reach Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sha_midstate as S
from .common import drop_table, ranked, small_side, write_table

FAN = 3
#: Levels per band: so many that a block has 2,187 nodes.
BAND = 7
#: Rows of one vector step.
STEP = 8192
#: A level of a path: nodes of the run, own slot, state before the slot (8 words), siblings left to right (8 words each).
LEVEL = 2 + 8 + 8 * (FAN - 1)
POWERS = FAN ** np.arange(40, dtype=np.int64)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def group_key(value: Column) -> Column:
    """A string without nulls that sorts like ``value``, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def document_leaves(docs: DataFrame, claimed: Column) -> DataFrame:
    """(doc_id, tree, leaf, claim): digests of each row, and of the row with ``claimed`` for its text."""
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    return docs.select(
        "doc_id",
        group_key(F.col("source")).alias("tree"),
        digest_of(*own, F.col("text")).alias("leaf"),
        digest_of(*own, claimed).alias("claim"),
    )


def levels_of(total: np.ndarray) -> np.ndarray:
    """Levels above ``total`` nodes."""
    return np.searchsorted(POWERS, total)


def build(position: np.ndarray, levels: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subtrees over whole blocks of nodes, in order: the path of every node (n, levels, LEVEL) and its block's root (8, n).

    ``position`` is the place within the block (0 begins a block) and
    ``levels`` how many levels the block has in this band.
    """
    n = len(position)
    path = np.zeros((n, int(levels.max(initial=0)), LEVEL), np.uint32)
    node = np.arange(n)  # of the current level, for every input
    block = np.cumsum(position == 0)
    for level in range(path.shape[1]):
        up = position // FAN
        first = np.flatnonzero(np.concatenate(([True], (block[1:] != block[:-1]) | (up[1:] != up[:-1]))))
        size = np.diff(np.append(first, len(up)))
        parent = np.repeat(np.arange(len(first)), size)
        slot = np.arange(len(up)) - first[parent]
        state = S.start(len(first))
        kept = []  # the copied state before each child slot
        for k in range(FAN):
            kept.append(state)
            has = size > k
            state = state.copy()
            state[:, has] = S.advance(state[:, has], S.digits(digest[:, first[has] + k]))
        made = S.finish(state, size)
        grows = levels > level
        # every input's own node of this level
        at, own = parent[node], slot[node]
        live = grows[node]
        path[live, level, 0] = size[at[live]]
        path[live, level, 1] = own[live]
        for k in range(FAN):
            mine = live & (own == k)
            path[mine, level, 2:10] = kept[k][:, at[mine]].T
            for j in range(FAN):
                if j != k:
                    seen = mine & (size[at] > j)
                    to = 10 + 8 * (j - (j > k))
                    path[seen, level, to : to + 8] = digest[:, first[at[seen]] + j].T
        digest = np.where(grows[first], made, digest[:, first])
        position, levels, block, node = up[first], levels[first], block[first], at
    return path, digest[:, node]


def fold(path: np.ndarray, digest: np.ndarray, proof: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests carried up their paths, and the hash state and length of the siblings met."""
    for level in path.transpose(1, 2, 0):
        size, slot = level[0], level[1]
        live = size > 0
        state = level[2:10].copy()
        state[:, live] = S.advance(state[:, live], S.digits(digest[:, live]))
        for k in range(FAN - 1):
            sibling = level[10 + 8 * k : 18 + 8 * k]
            met = live & (size > k + 1)
            proof = proof.copy()
            proof[:, met] = S.advance(proof[:, met], S.digits(sibling[:, met]))
            blocks = blocks + met
            right = met & (slot <= k)
            state[:, right] = S.advance(state[:, right], S.digits(sibling[:, right]))
        digest = np.where(live, S.finish(state, size), digest)
    return digest, proof, blocks


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a partition in pieces that end where a block ends."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        starts = np.flatnonzero(np.asarray(table["position"]) == 0)
        if len(starts) and rows + starts[-1] >= STEP:
            yield pa.concat_tables([*held, table.slice(0, starts[-1])]).combine_chunks()
            table, held, rows = table.slice(starts[-1]), [], 0
        held.append(table)
        rows += len(table)
    if rows:
        yield pa.concat_tables(held).combine_chunks()


def _binary(words: np.ndarray) -> pa.Array:
    return pa.array(S.to_bytes(words), pa.binary())


def _paths_binary(path: np.ndarray, levels: np.ndarray) -> pa.Array:
    return pa.array([p[:k].astype(">u4").tobytes() for p, k in zip(path, levels.tolist())], pa.binary())


def _built(table: pa.Table, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    levels = np.minimum(band, levels_of(np.asarray(table["total"])))
    path, top = build(np.asarray(table["position"]), levels, S.to_words(table["digest"].to_pylist()))
    return levels, path, top


def _fold_leaves(band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            _, path, top = _built(table, band)
            n = len(table)
            claim, proof, met = fold(path, S.to_words(table["claim"].to_pylist()), S.start(n), np.zeros(n, np.int64))
            kept = [table[c].combine_chunks() for c in ("doc_id", "tree", "block", "position", "total", "digest")]
            new = [_binary(top), _binary(claim), _binary(proof), pa.array(met)]
            yield from pa.table([*kept, *new], names=["doc_id", "tree", "block", "position", "total", "leaf", "top", "claim", "proof", "met"]).to_batches(STEP)

    return run


def _node_paths(band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            levels, path, top = _built(table, band)
            kept = [table[c].combine_chunks() for c in ("tree", "block", "position", "total")]
            yield from pa.table([*kept, _binary(top), _paths_binary(path, levels)], names=["tree", "block", "position", "total", "top", "path"]).to_batches(STEP)

    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            rows = batch.slice(at, STEP)
            raw = rows["path"].to_pylist()
            path = np.zeros((len(raw), max(map(len, raw)) // (4 * LEVEL), LEVEL), np.uint32)
            for i, r in enumerate(raw):
                own = np.frombuffer(r, ">u4").reshape(-1, LEVEL)
                path[i, : len(own)] = own
            words = [S.to_words(rows[c].to_pylist()) for c in ("claim", "proof")]
            folded, proof, met = fold(path, *words, np.asarray(rows["met"]))
            yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["leaf"], rows["subroot"], _binary(S.finish(proof, met)), _binary(folded)], names=["doc_id", "leaf", "subroot", "proof", "folded"])


def _dealt(nodes: DataFrame, block: int) -> DataFrame:
    """``nodes(tree, rank, total, ...)`` with whole blocks in one partition, in order."""
    placed = nodes.withColumn("block", F.floor(F.col("rank") / block)).withColumn("position", F.col("rank") % block)
    return placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")


def _above(blocks: DataFrame, block: int) -> DataFrame:
    """The nodes of the next band: one per block."""
    return blocks.filter("position = 0").select(
        "tree", F.col("block").alias("rank"), F.ceil(F.col("total") / block).alias("total"), F.col("top").alias("digest")
    )


def _bands(nodes: DataFrame, most: int, band: int) -> tuple[list[DataFrame], DataFrame]:
    """Path tables of the bands above ``nodes`` (``most`` in the largest tree), and (tree, top): the roots."""
    tables = []
    while most > 1:
        shape = "tree string, block long, position long, total long, top binary, path binary"
        tables.append(write_table(_dealt(nodes, FAN**band).select("tree", "block", "position", "total", "digest").mapInArrow(_node_paths(band), shape), "merkle_band"))
        nodes, most = _above(tables[-1], FAN**band), -(-most // FAN**band)
    return tables, nodes.select("tree", F.col("digest").alias("top"))


def _joined_paths(starts: DataFrame, tables: list[DataFrame], band: int) -> DataFrame:
    """``starts(tree, at)`` with ``path``, the levels of all bands above the node ``at`` of the tree."""
    out = starts.withColumn("path", F.lit(b""))
    for k, table in enumerate(tables):
        step = table.select(F.col("tree").alias("t"), (F.col("block") * FAN**band + F.col("position")).alias("i"), F.col("path").alias("more"))
        here = F.floor(F.col("at") / FAN ** (band * k))
        out = out.join(small_side(step, 4 * LEVEL * band), (F.col("tree") == F.col("t")) & (here == F.col("i")))
        out = out.withColumn("path", F.concat("path", "more")).drop("t", "i", "more")
    return out


def manifest(leaves: DataFrame, band: int = BAND) -> DataFrame:
    """One row per row of ``leaves(doc_id, tree, leaf, claim)``; all digests in lower-case hex.

    ``leaf``; ``subroot`` of its tree; ``root`` over all trees;
    ``proof_sha256`` of its siblings on the way up, left to right;
    ``folded_root`` from ``claim`` in the leaf's place; ``verified`` if that is the root.
    """
    leaves = write_table(leaves.withColumn("tie", F.monotonically_increasing_id()), "merkle_leaves")
    id_type = leaves.schema["doc_id"].dataType.simpleString()
    placed = ranked(leaves, "doc_id", "leaf", "claim", "tie", group="tree", total="total")
    most = placed.agg(F.max("total")).first()[0]
    hexed = lambda c: F.lower(F.hex(c))
    if most is None:
        return leaves.select(
            "doc_id", hexed("leaf").alias("leaf"), *[F.lit("").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")], F.lit(False).alias("verified")
        ).limit(0)
    shape = f"doc_id {id_type}, tree string, block long, position long, total long, leaf binary, top binary, claim binary, proof binary, met long"
    dealt = _dealt(placed.withColumnRenamed("leaf", "digest"), FAN**band).select("doc_id", "tree", "block", "position", "total", "digest", "claim")
    rows = write_table(dealt.mapInArrow(_fold_leaves(band), shape), "merkle_rows")
    drop_table(leaves)

    blocks = write_table(_above(rows, FAN**band), "merkle_blocks")
    tables, tops = _bands(blocks, -(-most // FAN**band), band)
    tops = write_table(tops, "merkle_subroots")
    trees = ranked(tops.select(F.lit("").alias("all"), F.col("tree").alias("name"), F.col("top").alias("digest")), "name", group="all", total="total")
    trees = write_table(trees.select(F.col("all").alias("tree"), "rank", "total", "digest", "name"), "merkle_trees")
    outer, roots = _bands(trees.drop("name"), trees.count(), band)
    root = roots.first()["top"]

    over = _joined_paths(trees.select("tree", F.col("rank").alias("at"), "name", "digest"), outer, band)
    over = write_table(over.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.col("path").alias("last")), "merkle_over")
    paths = _joined_paths(blocks.select("tree", F.col("rank").alias("at")), tables, band)
    bytes_of = 4 * LEVEL * (band * (len(tables) + len(outer))) + 100
    paths = paths.join(small_side(over, bytes_of), "tree")
    paths = write_table(paths.select("tree", F.col("at").alias("block"), F.concat("path", "last").alias("path"), "subroot"), "merkle_paths")

    found = rows.join(small_side(paths, bytes_of), ["tree", "block"]).select("doc_id", "leaf", "claim", "proof", "met", "path", "subroot")
    found = found.mapInArrow(_finish, f"doc_id {id_type}, leaf binary, subroot binary, proof binary, folded binary")
    return found.select(
        "doc_id",
        hexed("leaf").alias("leaf"),
        hexed("subroot").alias("subroot"),
        F.lit(root.hex()).alias("root"),
        hexed("proof").alias("proof_sha256"),
        hexed("folded").alias("folded_root"),
        (F.col("folded") == F.lit(bytes(root))).alias("verified"),
    )


def document_manifest(docs: DataFrame, claimed: Column | None = None, band: int = BAND) -> DataFrame:
    """The manifest of ``docs`` by source; ``claimed`` is the text to be checked in place of each row's own."""
    return manifest(document_leaves(docs, F.col("text") if claimed is None else claimed), band)
