"""Prefix trie of conversations: every distinct opening is a node; subtree totals by a roll-up in depth bands.

1. ``conversation_turns``: one scan to narrow rows (digest and length of a
   turn).  Texts are not read again.  The place of a turn comes from a range
   sort, so a conversation with a third of all rows spreads over many tasks.
2. ``prefixes``: the id of a node is the exclusive or, over its turns, of two
   64-bit hashes of (place, digest).  That sum can be split: chunks of
   ``CHUNK`` turns are summed first, so no conversation is walked in one task.
   Two different openings would need the same 128 bits to be taken for one.
3. ``trie_nodes``: one aggregate by node id, partial before the shuffle, so an
   opening that very many conversations share sends one row per task.
4. ``subtree_totals``: a node explodes only to its ancestors within its band
   of ``BAND`` depths (at most ``BAND`` rows).  The totals of a band's own
   nodes meet at the band's root; those roots form a tree of 1/``BAND`` of the
   depth, which is rolled up in the same way.  Its completed totals are handed
   to the nodes just above, and one explosion finishes every band at once:
   about log(depth) / log(``BAND``) rounds, whatever the depth.
5. Ends: ids of the conversations that end at a node are ranked, joined into
   pieces of ``PIECE`` ids by Spark, and hashed piece after piece.  A digest is
   one stream by definition, so the pieces of one node pass one task; it holds
   one piece at a time.

Defined results: rows without a ``conv_id`` belong to no conversation and are
left out.  A null turn comes first; rows of equal turn are ordered by digest,
and repeated rows are turns of their own.  Null role and text are empty.  A
conversation without turns ends at the root.  An empty table has no nodes.
Other columns are not read.  Only digests and lengths of long texts travel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked, write_table

#: Depths per band.
BAND = 16
#: Turns of a conversation whose hashes are summed in one window; a multiple of ``BAND``.
CHUNK = 4096
#: Conversation ids per piece of a list to be hashed.
PIECE = 256
#: A conversation opens with turns of the one whose id is its own rounded down to this.
FAMILY = 100
#: Its number of opening turns is a checksum of its id modulo this.
OPENINGS = 6

NODE = ("x1", "x2")


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """Written table (conv_id, place from 0, n_turns, digest, size): the turns of every conversation in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.char_length(text).cast("long").alias("size"),
    )
    placed = ranked(rows, "turn", "digest", group="conv_id", total="n_turns")
    return write_table(placed.select("conv_id", F.col("rank").alias("place"), "n_turns", "digest", "size"), "turns")


def openings(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % OPENINGS


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, digest, size, last): every conversation behind the opening of its family's first; depth 0 is its start.

    A conversation takes over at most ``OPENINGS - 1`` turns, so a family's
    opening is a short list, and a family has ``FAMILY`` members at most.
    """
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    turn = F.struct("place", "digest", "size")
    heads = (
        turns.filter((F.col("conv_id") == first) & (F.col("place") < OPENINGS - 1))
        .groupBy(F.col("conv_id").alias("family"))
        .agg(F.array_sort(F.collect_list(turn)).alias("head"))
    )
    convs = turns.filter("place = 0").select("conv_id", "n_turns", first.alias("family"), openings(F.col("conv_id")).alias("h"))
    convs = convs.join(heads, "family", "left").withColumn("taken", F.least("h", F.greatest(F.coalesce(F.size("head"), F.lit(0)), F.lit(0))))
    convs = write_table(
        convs.select(
            "conv_id",
            "h",
            F.col("taken").cast("long").alias("taken"),
            (F.col("taken") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).cast("long").alias("length"),
            F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("taken").cast("int")).alias("head"),
        ),
        "conversations",
    )
    starts = convs.select("conv_id", "length", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("size"))
    copied = convs.select("conv_id", "length", F.explode("head").alias("t")).select("conv_id", "length", F.col("t.place") + 1, "t.digest", "t.size")
    own = turns.join(convs.select("conv_id", "h", "taken", "length"), "conv_id").filter("place >= h")
    own = own.select("conv_id", "length", F.col("place") + 1 + F.col("taken") - F.col("h"), "digest", "size")
    return starts.union(copied).union(own).select("conv_id", "depth", "digest", "size", (F.col("depth") == F.col("length")).alias("last"))


def prefixes(rows: DataFrame) -> DataFrame:
    """Written table: ``rows(conv_id, depth, digest, size, last)`` with the node (x1, x2) that each row's turns up to it make, and its parent (p1, p2)."""
    parts = [F.when(F.col("digest").isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit(i), "depth", "digest")).alias(f"e{i}") for i in (1, 2)]
    rows = write_table(rows.select("conv_id", "depth", "size", "last", F.floor(F.col("depth") / CHUNK).alias("chunk"), *parts), "trie_turns")
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("e1").alias("s1"), F.bit_xor("e2").alias("s2"))
    sums = sums.select("conv_id", "chunk", *[F.coalesce(F.bit_xor(f"s{i}").over(before), F.lit(0)).alias(f"b{i}") for i in (1, 2)])
    here = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.join(sums, ["conv_id", "chunk"])
    for i in (1, 2):
        found = found.withColumn(f"x{i}", F.col(f"b{i}").bitwiseXOR(F.bit_xor(f"e{i}").over(here)))
    parent = [F.col(f"x{i}").bitwiseXOR(F.col(f"e{i}")).alias(f"p{i}") for i in (1, 2)]
    return write_table(found.select("conv_id", "depth", "size", "last", "x1", "x2", *parent), "prefixes")


def with_ancestors(paths: DataFrame, step: int) -> DataFrame:
    """Rows at every ``step`` depths, with ``above``: the nodes before it in its band, from the band's root down."""
    rows = paths.filter(F.col("depth") % step == 0).withColumn("depth", F.floor(F.col("depth") / step))
    band = Window.partitionBy("conv_id", F.floor(F.col("depth") / BAND)).orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("above", F.collect_list(F.struct(*NODE)).over(band))


def trie_nodes(paths: DataFrame) -> DataFrame:
    """Written table of the nodes: x1, x2, p1, p2, depth, conv_id, n_convs, n_ends, size, above."""
    found = with_ancestors(paths, 1).groupBy(*NODE).agg(
        F.first("p1").alias("p1"),
        F.first("p2").alias("p2"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("last").cast("long")).alias("n_ends"),
        F.first("size").alias("size"),
        F.first("above").alias("above"),
    )
    return write_table(found, "trie_nodes")


def _spread(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Each node's values, to itself and to the ancestors in its band."""
    up = F.concat("above", F.array(F.struct(*NODE)))
    return nodes.select(F.explode(up).alias("at"), *values).select("at.x1", "at.x2", *values)


def with_carried(nodes: DataFrame, paths: DataFrame, values: list[str], deepest: int, step: int = 1) -> DataFrame:
    """``nodes(x1, x2, conv_id, depth, above, values)`` of one level with the completed totals of the bands below added.

    ``step`` is how many turns one depth of this level stands for, ``deepest``
    the largest depth of this level.
    """
    if deepest < BAND:
        return nodes
    root = F.when(F.size("above") > 0, F.col("above")[0]).otherwise(F.struct(*NODE))
    inside = nodes.groupBy(root.alias("root")).agg(*[F.sum(v).alias(v) for v in values]).select("root.x1", "root.x2", *values)
    tops = nodes.filter(F.col("depth") % BAND == 0).select(*NODE, "conv_id")
    lists = with_ancestors(paths, step * BAND).groupBy(*NODE).agg(F.first("depth").alias("depth"), F.first("above").alias("above"))
    upper = write_table(tops.join(lists, list(NODE)).join(inside, list(NODE)), "band_roots")
    full = _spread(with_carried(upper, paths, values, deepest // BAND, step * BAND), values)
    full = full.groupBy(*NODE).agg(*[F.sum(v).alias(v) for v in values])
    # a band root hands its total to the node one depth above, found on the path of one of its conversations
    at = upper.filter("depth > 0").join(full.withColumnsRenamed({v: f"full_{v}" for v in values}), list(NODE))
    at = at.select(F.col("conv_id").alias("c"), (F.col("depth") * BAND * step - step).alias("d"), *[F.col(f"full_{v}").alias(v) for v in values])
    handed = paths.join(at, (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d"))).groupBy(*NODE).agg(*[F.sum(v).alias(f"more_{v}") for v in values])
    out = nodes.join(handed, list(NODE), "left")
    out = out.withColumns({v: F.col(v) + F.coalesce(f"more_{v}", F.lit(0)) for v in values}).drop(*[f"more_{v}" for v in values])
    return write_table(out, "carried")


def ends_digests(paths: DataFrame) -> DataFrame:
    """(x1, x2, ends): SHA-256 of the ascending, comma-joined ids of the conversations that end at a node."""
    ends = paths.filter("last").select(F.struct(*NODE).alias("node"), "conv_id")
    pieces = (
        ranked(ends, "conv_id", group="node")
        .groupBy("node", F.floor(F.col("rank") / PIECE).alias("piece"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    )
    dealt = pieces.select("node.x1", "node.x2", "piece", "ids").repartition(*NODE).sortWithinPartitions(*NODE, "piece")
    return dealt.mapInArrow(_hash_pieces, "x1 long, x2 long, ends string")


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, state, done = None, None, []
    for batch in batches:
        for x1, x2, ids in zip(*(batch[c].to_pylist() for c in ("x1", "x2", "ids"))):
            if (x1, x2) == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                done.append((*node, state.hexdigest()))
            node, state = (x1, x2), hashlib.sha256(ids.encode())
        if done:
            yield _hashed(done)
            done = []
    if node is not None:
        yield _hashed([(*node, state.hexdigest())])


def _hashed(rows: list[tuple]) -> pa.RecordBatch:
    x1, x2, ends = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(x1, pa.int64()), pa.array(x2, pa.int64()), pa.array(ends, pa.string())], names=["x1", "x2", "ends"])


def trie(rows: DataFrame) -> DataFrame:
    """One row per node of ``rows(conv_id, depth, digest, size, last)``: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = prefixes(rows)
    nodes = trie_nodes(paths)
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    values = ["leaves", "saved"]
    own = nodes.withColumns({"leaves": (F.col("n_convs") == F.col("n_ends")).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("size")})
    full = _spread(with_carried(own.select(*NODE, "conv_id", "depth", "above", *values), paths, values, deepest), values)
    children = nodes.filter("depth > 0").select(F.col("p1").alias("x1"), F.col("p2").alias("x2"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(1).cast("long").alias("children"))
    sums = full.withColumn("children", F.lit(0).cast("long")).union(children).groupBy(*NODE).agg(*[F.sum(v).alias(v) for v in (*values, "children")])
    named = nodes.select(F.col("x1").alias("up1"), F.col("x2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    known = nodes.select(*NODE, "p1", "p2", "conv_id", "depth", "n_convs")
    found = known.join(named, (F.col("depth") > 0) & (F.col("p1") == F.col("up1")) & (F.col("p2") == F.col("up2")), "left")
    found = found.join(sums, list(NODE)).join(ends_digests(paths), list(NODE), "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, each rebuilt behind its family's opening."""
    return trie(rebuilt(conversation_turns(conversations)))
