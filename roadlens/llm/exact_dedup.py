"""Exact dedup: heavy hitters found by a Misra-Gries summary, removed map-side; the rest by an ordinary shuffle.

Texts are equal when identical after lower-casing A-Z; the row with the
largest document id stays.  Only DataFrame functions, no Python in tasks.

1. ``digests``: one scan of the texts writes (doc_id, digest, row_no).
2. ``heavy_winners``: Spark's ``approx_top_k`` functions (a mergeable
   Misra-Gries summary with ``counters`` counters) summarise 64-bit hashes of
   the digests per task, merge the summaries in ``MERGE_GROUPS`` groups and
   those in one, so the last task reads a fixed number of them.  The
   ``candidates`` most frequent are counted again exactly by their digests;
   what the summary overestimated, or a hash threw together, falls out.  The
   broadcast of the winners has a fixed bound.
3. ``assign``: rows of heavy digests meet their winner in a broadcast join
   and never shuffle.  Every other group is smaller than each of the
   candidates (so below about ``rows / candidates``, within the summary's error
   of ``rows / counters``) and meets in one window over the digest.

Edge cases: a null text counts as the empty text.  A null id loses against
any other id.  Rows that repeat the same id and text are copies of each
other: exactly one of them stays (the last in reading order).  An empty table
gives an empty result.  Other columns, whatever their names, pass through
``deduplicate`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, text_digest, without_rows, write_table

#: Counters of the Misra-Gries summary: its counts are off by rows / COUNTERS at most.
COUNTERS = 32_768
#: Digests taken from the summary, and so most rows of the broadcast winners.
CANDIDATES = 4_096
MERGE_GROUPS = 128


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", own: bool = False) -> DataFrame:
    """Written table (doc_id, digest, row_no); with ``own`` also ``digest_raw``, the digest of the text as it stands."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cols = [F.col(id_col).alias("doc_id"), F.sha2(lower_ascii(text).cast("binary"), 256).alias("digest")]
    if own:
        cols.append(text_digest(F.col(text_col)).alias("digest_raw"))
    return write_table(docs.select(*cols).withColumn("row_no", F.monotonically_increasing_id()), "digests")


def heavy_winners(rows: DataFrame, counters: int = COUNTERS, candidates: int = CANDIDATES) -> DataFrame:
    """Written table (digest, n, winner) of the verified frequent digests; at most ``candidates`` rows."""
    mark = F.xxhash64("digest")
    summarise = F.expr(f"approx_top_k_accumulate(mark, {int(counters)})").alias("summary")
    marks = rows.select(mark.alias("mark"), (F.spark_partition_id() % MERGE_GROUPS).alias("part"))
    parts = marks.groupBy("part").agg(summarise).select("summary")
    parts = parts.union(marks.filter(F.lit(False)).agg(summarise))  # an empty table has a summary too
    # Spark's combine cannot take a partition without a row, so the few summaries meet in one partition
    whole = parts.coalesce(1).agg(F.expr(f"approx_top_k_combine(summary, {int(counters)})").alias("summary"))
    named = whole.select(F.explode(F.expr(f"approx_top_k_estimate(summary, {int(candidates)})")).alias("t")).select(F.col("t.item").alias("mark"))
    exact = (
        rows.withColumn("mark", mark)
        .join(F.broadcast(named), "mark", "left_semi")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row_no")).alias("winner"))
        .filter(F.col("n") > 1)
    )
    return write_table(exact, "heavy_digests")


def assign(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Every row of ``rows`` with ``n`` (size of its group) and ``winner`` (id and row number of the row that stays)."""
    found = rows.join(F.broadcast(heavy), "digest")
    group = Window.partitionBy("digest")
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").withColumns(
        {"n": F.count(F.lit(1)).over(group), "winner": F.max(F.struct("doc_id", "row_no")).over(group)}
    )
    return found.unionByName(rest)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = digests(docs, id_col, text_col)
    return assign(rows, heavy_winners(rows)).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row_no") == F.col("winner.row_no")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are."""
    rows = digests(docs, own=True)
    found = assign(rows, heavy_winners(rows))
    lost = found.filter(F.col("row_no") != F.col("winner.row_no"))
    same_id = F.col("doc_id").eqNullSafe(F.col("winner.doc_id"))
    # a loser with its winner's id: named by (id, text) it cannot be told from a winner with the very same text
    lost = write_table(lost.select("doc_id", F.col("digest_raw").alias("digest"), same_id.alias("same_id"), F.col("digest").alias("class")), "lost_rows")
    counts = {r["same_id"]: r["count"] for r in lost.groupBy("same_id").count().collect()}
    kept = without_rows(docs, lost.filter(~F.col("same_id")), counts.get(False, 0))
    if not counts.get(True):
        return kept
    # ids that repeat within a class: one row of each such class, chosen by a partial aggregate
    again = lost.filter("same_id").select(F.col("class").alias("again")).distinct()
    packed = kept.select(
        F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"),
        F.sha2(lower_ascii(F.coalesce(F.col("text"), F.lit(""))).cast("binary"), 256).alias("class"),
    )
    alone = packed.join(again, F.col("class") == F.col("again"), "left_anti").select("row.*")
    one = packed.join(again, F.col("class") == F.col("again"), "left_semi").groupBy("class").agg(F.first("row").alias("row"))
    return alone.unionByName(one.select("row.*"))
