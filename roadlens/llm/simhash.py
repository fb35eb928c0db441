"""SimHash near-dedup: fingerprints, pigeonhole blocks, verified Hamming links, components.

1. ``fingerprints``: one scan; an Arrow function hashes the word shingles of a
   whole text (XXH64, seed 42) and takes the majority of every bit.  Written
   as a narrow table; texts are not read again.
2. Equal fingerprints are one node, so copies never meet in pairs.
3. ``close_pairs``: a fingerprint is cut into ``max_distance + 2`` blocks; two
   fingerprints within the distance agree on at least two of them, so each
   pair of blocks is a join key.  Blocks with up to ``BLOCK_ROWS`` nodes are
   joined and every pair is verified by its Hamming distance.
4. ``crowded_links``: blocks with more nodes would give a square of pairs.
   Their nodes are blocked once more, down to single bits: each names the
   few fingerprints one step away, nodes that name the same one are within the
   distance, and such a meeting place holds 65 nodes at most by construction.
   The links are a star per meeting place, which joins the same nodes as all
   pairs would.  Work is linear in the nodes and no case is left out.
5. Components by star steps; the label is the smallest document id.

Edge cases: null and blank texts have fingerprint zero and are linked like any
other.  A null id counts as larger than every other id.  Rows that repeat an
id are separate rows with one label; ``near_deduplicate`` keeps exactly one
row of each component.  Very long texts are hashed a piece at a time.  An empty table gives an empty result.  Other columns
pass through ``near_deduplicate`` unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_TABLE, drop_table, text_digest, without_rows, write_table
from .components import connected_components

BITS = 64
SEED = 42
#: Blocks with more nodes than this are blocked again instead of paired.
BLOCK_ROWS = 64
#: A byte lane of a 64-bit word can count this many ones.
LANE = 255
LANES = np.uint64(0x0101010101010101)


#: Bytes of a text that are turned into words at once.
PIECE_BYTES = 1 << 20
SPACE = re.compile(rb"[\t-\r ]")


def ones(hashes: np.ndarray) -> np.ndarray:
    """How many of ``hashes`` have a 1, for each of the 64 bits."""
    starts = np.arange(0, len(hashes), LANE)
    counts = np.zeros((8, 8), np.int64)  # bit within a byte, byte
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & LANES, starts)
        counts[bit] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.T.reshape(-1)


def majority(counts: np.ndarray, n: int) -> int:
    """The 64-bit word whose bit is 1 where more than half of ``n`` hashes have a 1."""
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, a piece of about ``PIECE_BYTES`` at a time (longer only by one word)."""
    at = 0
    while at < len(text):
        end = at + PIECE_BYTES
        if end < len(text):
            gap = SPACE.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[at:end].translate(LOWER_TABLE).split()
        at = end


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of a UTF-8 text over ``shingle``-word shingles (fewer words: the whole sequence; none: zero)."""
    digest = xxhash.xxh64_intdigest
    total, n, last = np.zeros(BITS, np.int64), 0, []
    for words in word_lists(text or b""):
        words = last + words
        if len(words) >= shingle:
            line = b" ".join(words)
            stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], stops[:-1] + 1))
            spans = zip(starts[: len(words) - shingle + 1].tolist(), stops[shingle - 1 :].tolist())
            hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, len(words) - shingle + 1)
            total += ones(hashes)
            n += len(hashes)
            words = words[len(words) - shingle + 1 :]
        last = words  # the words that later shingles begin with
    if n:
        return majority(total, n)
    return digest(b" ".join(last), SEED) if last else 0


def fingerprint_udf(shingle: int):
    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        words = np.fromiter((fingerprint(t, shingle) for t in texts.to_pylist()), np.uint64, len(texts))
        return pa.array(words.view(np.int64))

    return simhash


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text", own: bool = False) -> DataFrame:
    """Written table (doc_id, row_no, fp); with ``own`` also ``digest`` of the text, which names the row."""
    cols = [F.col(id_col).alias("doc_id"), fingerprint_udf(shingle)(F.col(text_col).cast("binary")).alias("fp")]
    if own:
        cols.append(text_digest(F.col(text_col)).alias("digest"))
    return write_table(docs.select(*cols).withColumn("row_no", F.monotonically_increasing_id()), "fingerprints")


def _masks(max_distance: int) -> list[int]:
    """One mask per pair of blocks; a pair within ``max_distance`` agrees on all bits of one of them."""
    n = max_distance + 2
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(word: int) -> int:
    return word - (1 << BITS) if word >= 1 << (BITS - 1) else word


def _block_rows(nodes: DataFrame, max_distance: int) -> DataFrame:
    keys = [F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(_masks(max_distance))]
    return nodes.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.block", "k.key")


def close_pairs(shared: DataFrame, max_distance: int) -> DataFrame:
    """Pairs (a, b) of nodes that share a block of bounded size, verified by Hamming distance."""
    left, right = shared.alias("l"), shared.alias("r")
    meet = (F.col("l.block") == F.col("r.block")) & (F.col("l.key") == F.col("r.key")) & (F.col("l.fp") < F.col("r.fp"))
    near = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= max_distance
    return left.join(right, meet & near).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def crowded_links(nodes: DataFrame, max_distance: int) -> DataFrame:
    """Star links among ``nodes`` that join exactly the pairs within ``max_distance`` (0 to 2)."""
    if max_distance < 1:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    bits = [F.lit(_signed(1 << i)) for i in range(BITS)]
    if max_distance == 1:  # one bit left out: nodes that agree on the rest
        steps = [F.struct(F.lit(i).alias("skip"), F.col("fp").bitwiseAND(F.bitwise_not(b)).alias("at")) for i, b in enumerate(bits)]
    else:  # at most one bit turned: nodes that meet are at most two apart, and those two apart meet
        steps = [F.struct(F.lit(-1).alias("skip"), F.col("fp").alias("at"))]
        steps += [F.struct(F.lit(-1).alias("skip"), F.col("fp").bitwiseXOR(b).alias("at")) for b in bits]
    near = nodes.select("fp", F.explode(F.array(*steps)).alias("s")).groupBy("s").agg(F.collect_set("fp").alias("met"))
    return (
        near.filter(F.size("met") > 1)
        .select(F.array_min("met").alias("a"), F.explode("met").alias("b"))
        .filter("a < b")
    )


def links(nodes: DataFrame, max_distance: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``nodes(fp)``; their components are those of all close pairs."""
    if not 0 <= max_distance <= 2:
        raise ValueError("max_distance must be 0, 1 or 2")
    blocks = _block_rows(nodes, max_distance)
    sizes = blocks.groupBy("block", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = write_table(blocks.join(sizes, ["block", "key"]), "shared_blocks")
    crowded = shared.filter(F.col("n") > block_rows).select("fp").distinct()
    few = shared.filter(F.col("n") <= block_rows).select("block", "key", "fp")
    found = write_table(close_pairs(few, max_distance).union(crowded_links(crowded, max_distance)), "close_pairs")
    drop_table(shared)
    return found


def components(rows: DataFrame, max_distance: int) -> DataFrame:
    """Every row of ``rows(doc_id, row_no, fp)`` with ``first``: (order, doc_id, row_no) of the smallest row reachable."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no")
    nodes = write_table(rows.groupBy("fp").agg(F.min(place).alias("first")), "nodes")
    roots = write_table(connected_components(links(nodes.select("fp"), max_distance)), "components")
    inside = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    lows = inside.groupBy("root").agg(F.min("first").alias("first"))
    labels = write_table(inside.select("fp", "root").join(lows, "root").select(F.col("fp").alias("node"), "first"), "labels")
    return rows.join(labels, F.col("fp") == F.col("node")).drop("node")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id."""
    found = components(fingerprints(docs, shingle, id_col, text_col), max_distance)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def near_deduplicate(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """The rows of ``docs`` without all but the smallest row of each component, all columns as they are."""
    found = components(fingerprints(docs, shingle, own=True), max_distance)
    ranked = found.select("doc_id", "digest", (F.col("row_no") == F.col("first.row_no")).alias("stays"))
    # (id, text) names a row; rows that repeat both are one name, and it stays if one of them does
    names = ranked.groupBy("doc_id", "digest").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n"))
    names = write_table(names.filter(~F.col("stays") | (F.col("n") > 1)), "lost_rows")
    lost = names.filter(~F.col("stays"))
    kept = without_rows(docs, lost, lost.count())
    again = names.filter("stays").select(F.col("doc_id").alias("again_id"), F.col("digest").alias("again_digest"))
    if again.isEmpty():
        return kept
    packed = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), text_digest(F.col("text")).alias("own"))
    same = F.col("row.doc_id").eqNullSafe(F.col("again_id")) & (F.col("own") == F.col("again_digest"))
    alone = packed.join(again, same, "left_anti").select("row.*")
    one = packed.join(again, same, "left_semi").groupBy("row.doc_id", "own").agg(F.first("row").alias("row"))
    return alone.unionByName(one.select("row.*"))
