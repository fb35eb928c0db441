"""Packing: optimal length buckets over the global histogram, token-budget batches inside each bucket.

1. Lengths are counted once into a narrow written table.
2. Spark groups the histogram of exact lengths.  D different lengths add up to
   at least D * D / 2 tokens, so it has at most the square root of twice the
   corpus's tokens as rows (14 million of two numbers at 10^14 tokens).
3. Dynamic programming on the driver chooses the boundaries of ``buckets``
   buckets with the least padding.  The cost has the Monge property, so the best
   cut moves one way and each step is a divide and conquer in D * log(D) time,
   a level of it at once.
4. Rows are range-sorted by (bucket, doc_id); their place inside a bucket is
   their place in the partition plus the rows of earlier partitions (one small
   row per partition and bucket).  No bucket is gathered anywhere.
5. A batch holds as many rows as fit ``token_budget`` padded tokens, at least one.

Whole documents are packed: one longer than the budget is a batch of its
own.  Edge cases: null and word-free texts have length 0 and are packed into
the first bucket.  Null ids sort first; ties and repeated rows keep separate
places.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranked, write_table

BUCKETS = 8
TOKEN_BUDGET = 8_192


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _step(least: np.ndarray, total: np.ndarray, lengths: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """One bucket more: for every j >= ``first``, the least of least[i] + (total[j] - total[i]) * lengths[j - 1] over
    first - 1 <= i < j, and the smallest such i.

    That i never moves back as j grows.  So the middle j of a range bounds the
    search of both halves; all middles of one level are searched together.
    """
    m = len(lengths)
    best, cut = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    ranges = np.array([[first, m, first - 1, m - 1]])  # j from, j to, i from, i to
    while len(ranges):
        mid = (ranges[:, 0] + ranges[:, 1]) // 2
        high = np.minimum(ranges[:, 3], mid - 1)
        size = high - ranges[:, 2] + 1
        starts = np.cumsum(size) - size
        i = np.arange(size.sum()) - np.repeat(starts, size) + np.repeat(ranges[:, 2], size)
        j = np.repeat(mid, size)
        cost = least[i] + (total[j] - total[i]) * lengths[j - 1]
        low = np.minimum.reduceat(cost, starts)
        hit = np.flatnonzero(cost == np.repeat(low, size))
        at = i[hit[np.searchsorted(hit, starts)]]
        best[mid], cut[mid] = low, at
        left = np.stack([ranges[:, 0], mid - 1, ranges[:, 2], at], axis=1)
        right = np.stack([mid + 1, ranges[:, 1], at, ranges[:, 3]], axis=1)
        ranges = np.concatenate([left, right])
        ranges = ranges[ranges[:, 0] <= ranges[:, 1]]
    return best, cut


def boundaries(lengths: np.ndarray, rows: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least total padding (ties: the shorter boundary first).

    ``lengths`` ascending, each with ``rows`` documents.
    """
    m = len(lengths)
    if not m:
        return []
    lengths = np.asarray(lengths, np.int64)
    total = np.concatenate(([0], np.cumsum(np.asarray(rows, np.int64))))
    least, cuts = np.concatenate(([0], total[1:] * lengths)), [np.zeros(m + 1, np.int64)]
    for k in range(2, min(buckets, m) + 1):
        least, cut = _step(least, total, lengths, k)
        cuts.append(cut)
    out, j = [], m
    for cut in reversed(cuts):
        out.append(int(lengths[j - 1]))
        j = cut[j]
    return out[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, length: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, n_tokens, bucket (from 1), bucket_tokens, batch (from 0, within the bucket), slot.

    ``length`` counts the tokens of a row (default: words of ``text``).
    """
    counted = (word_count(F.col("text")) if length is None else F.coalesce(length, F.lit(0))).cast("long")
    rows = write_table(docs.select("doc_id", counted.alias("n_tokens")).withColumn("row_no", F.monotonically_increasing_id()), "lengths")
    histogram = rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by("n_tokens")
    uppers = boundaries(np.asarray(histogram["n_tokens"]), np.asarray(histogram["n"]), buckets)
    number, tokens = F.lit(len(uppers)), F.lit(uppers[-1] if uppers else 0)
    for i, upper in reversed(list(enumerate(uppers[:-1], 1))):
        number = F.when(F.col("n_tokens") <= upper, i).otherwise(number)
        tokens = F.when(F.col("n_tokens") <= upper, upper).otherwise(tokens)
    sized = rows.withColumns({"bucket": number.cast("int"), "bucket_tokens": tokens.cast("long")})
    placed = ranked(sized, "doc_id", "row_no", group="bucket")
    capacity = F.expr(f"greatest(1L, {int(token_budget)}L div greatest(bucket_tokens, 1L))")
    return placed.withColumn("capacity", capacity).select(
        "doc_id", "n_tokens", "bucket", "bucket_tokens", F.expr("rank div capacity").alias("batch"), F.expr("rank % capacity").alias("slot")
    )
