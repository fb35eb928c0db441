"""Count-based windows: each driver's last N events, and decisions taken every K events.

Skew-safe plan.  A plain ``Window.partitionBy("driver_id")`` puts every event
of a driver into one task, and one driver may own a third of the data.  So the
events of a driver are cut into *chunks* of at most ``chunk_size`` rows:

* one partial aggregate counts the rows per driver and bucket of arrival
  numbers (``seq div (chunk_size / 2)``, so at most half a chunk each);
* a running sum over a driver's buckets merges neighbouring buckets until
  half a chunk is full.  A driver with few rows in every bucket still gets
  full chunks, and an ordinary driver gets a single one;
* only drivers that need several chunks are listed, so the list that the events
  are joined with has at most ``2 * rows / chunk_size`` chunks and is empty if no
  driver is hot.  The join is a plain equi-join (events without a driver are a
  key like any other) whose strategy is left to the optimizer.

A frame of the last N events may reach back into the driver's earlier chunk,
so each later chunk receives a *halo*: the N-1 events just before its first
row.  Those are always among the last N-1 rows of the earlier chunks
("tails"): (N-1) rows per full chunk.  With the halo attached, a bounded
``rowsBetween(-(N-1), 0)`` frame per (driver, chunk) gives exact results; halo
rows are then dropped.  The next event of the same driver (how long a buffer
state stays current) is ``lead`` inside a chunk, and for its last row the first
row of the driver's next chunk, which the list of chunks knows.

There is one plan for every size of data; nothing is counted while it is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import materialize
from .events import DEMO_EVENT_DECISION_FIELDS, build_event_decision_rows
from .windows import window_action, window_decision_type, window_priority

#: Most partition offsets that are broadcast (two numbers each).
MOST_OFFSETS = 1_000_000
DEFAULT_CHUNK = 1 << 22  # most rows of one (driver, chunk) partition (~4 million)

ROLLING_DECISION_FIELDS = (
    "decision_source",
    "decision_ts",
    "driver_id",
    "decision_type",
    "priority",
    "recommended_action",
    "customer_message",
    "event_count",
    "km_driven",
    "risk_event_count",
    "risk_score_window",
    "risk_intensity",
    "phone_usage_count",
)


def _measures() -> dict[str, Column]:
    return {
        "m_km": F.col("distance_delta_km"),
        "m_risk": F.col("risk_event").cast("int"),
        "m_score": F.col("risk_score_event"),
        "m_phone": F.col("is_phone_usage").cast("int"),
    }


#: The driver as a key that is never null (events without a driver are a key like any other).
KEY = ("_id", "_none")


def _with_key(df: DataFrame) -> DataFrame:
    return df.withColumns({"_id": F.coalesce("driver_id", F.lit("")), "_none": F.col("driver_id").isNull()})


def hot_chunks(df: DataFrame, seq: str, chunk_size: int) -> DataFrame:
    """(KEY, _bucket, _chunk, _next_first) of every bucket of the drivers that need more than one chunk.

    ``_next_first`` is the first event number of the driver's next chunk.
    """
    half = max(1, chunk_size // 2)
    sizes = _with_key(df).groupBy(*KEY, F.expr(f"CAST({seq} AS BIGINT) div {half}").alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(seq).alias("_first")
    )
    driver = Window.partitionBy(*KEY)
    before = driver.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    chunked = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_chunk", F.expr(f"_before div {half}"))
    # a bucket has at most half a chunk, so the chunks of a driver are numbered without gaps
    following = driver.orderBy("_chunk").rangeBetween(1, 1)
    chunked = chunked.withColumns({"_next_first": F.min("_first").over(following), "_last": F.max("_chunk").over(driver)})
    return chunked.filter(F.col("_last") > 0).select(*KEY, "_bucket", "_chunk", "_next_first")


def assign_chunks(df: DataFrame, seq: str, chunk_size: int) -> DataFrame:
    """``df`` with KEY, ``_chunk`` (at most ``chunk_size`` rows each; null for drivers of a single chunk) and ``_next_first``."""
    half = max(1, chunk_size // 2)
    rows = _with_key(df).withColumn("_bucket", F.expr(f"CAST({seq} AS BIGINT) div {half}"))
    return rows.join(hot_chunks(df, seq, chunk_size), [*KEY, "_bucket"], "left").drop("_bucket")


def _halo(base: DataFrame, n: int, seq: str) -> DataFrame:
    """For the later chunks of drivers with several: the n-1 rows of the driver just before each (``_home`` false)."""
    hot_rows = base.filter(F.col("_chunk").isNotNull())
    # Last n-1 rows of each chunk: row_number <= n-1 plans as a WindowGroupLimit, whose partial step runs
    # before the shuffle, so at most n-1 rows per (driver, chunk) and map task are shuffled here.
    per_chunk_desc = Window.partitionBy(*KEY, "_chunk").orderBy(F.col(seq).desc())
    tails = hot_rows.withColumn("_k", F.row_number().over(per_chunk_desc)).filter(F.col("_k") <= n - 1).drop("_k")
    # Over a driver's tails ((n-1) rows per full chunk), a tail row belongs to the halo of every chunk whose
    # first tail row is one of the next n-1 tail rows.
    per_driver = Window.partitionBy(*KEY).orderBy(seq)
    prev_chunk = F.lag("_chunk").over(per_driver)
    tails = tails.withColumn("_starts", prev_chunk.isNull() | (prev_chunk != F.col("_chunk")))
    targets = F.array(*[F.when(F.lead("_starts", j).over(per_driver), F.lead("_chunk", j).over(per_driver)) for j in range(1, n)])
    return (
        tails.withColumn("_targets", targets)
        .withColumn("_target", F.explode("_targets"))
        .filter(F.col("_target").isNotNull())
        .withColumn("_chunk", F.col("_target"))
        .drop("_target", "_targets", "_starts")
        .withColumn("_home", F.lit(False))
    )


def rolling_features(df: DataFrame, n: int = 12, seq: str = "event_no", chunk_size: int | None = None) -> DataFrame:
    """Per event: count, km, risk events, score sum and phone count over the driver's last ``n`` events.

    ``seq`` orders a driver's events (arrival number).  Adds ``event_count``,
    ``km_window`` (unrounded), ``risk_event_count``, ``risk_score_window``,
    ``phone_usage_count`` and ``next_seq`` (the driver's next event number, null
    for its last event).  ``chunk_size`` bounds the rows of one partition.
    """
    base = assign_chunks(df.withColumns(_measures()), seq, chunk_size or DEFAULT_CHUNK)
    rows = base.withColumn("_home", F.lit(True))
    if n > 1:
        rows = rows.unionByName(_halo(base, n, seq).select(*rows.columns))
    part = Window.partitionBy(*KEY, "_chunk").orderBy(seq)
    frame = part.rowsBetween(-(n - 1), 0)
    rolled = rows.withColumns(
        {
            "event_count": F.count(F.lit(1)).over(frame),
            "km_window": F.sum("m_km").over(frame),
            "risk_event_count": F.sum("m_risk").over(frame).cast("long"),
            "risk_score_window": F.sum("m_score").over(frame).cast("long"),
            "phone_usage_count": F.sum("m_phone").over(frame).cast("long"),
            # after the last row of a chunk comes the first row of the driver's next chunk
            "next_seq": F.coalesce(F.lead(seq).over(part), F.col("_next_first")),
        }
    )
    return rolled.filter(F.col("_home")).drop("_next_first", *KEY, "_chunk", "_home", *_measures().keys())


def rolling_decision_columns() -> dict[str, Column]:
    """The window rule chain on a count-window buffer (unrounded km and intensity compared)."""
    decision = F.col("decision_type")
    return {
        "priority": window_priority(decision),
        "recommended_action": window_action(decision),
        "customer_message": F.when(decision == F.lit(C.GRANT_SAFE_DRIVING_POINTS), F.lit(C.MESSAGE_POINTS)).otherwise(
            F.lit(C.MESSAGE_ROLLING_RISK)
        ),
        "decision_source": F.lit(C.SOURCE_ROLLING),
        "decision_ts": F.current_timestamp(),
    }


TICK_PAYLOAD = ROLLING_DECISION_FIELDS


def tick_decision_ranges(
    df: DataFrame, n: int = 12, every: int = 10, seq: str = "event_no", chunk_size: int | None = None
) -> DataFrame:
    """Each buffer state that yields a decision, once, with the ticks it is judged at: ``first_tick`` ..
    ``last_tick`` (step ``every``) and ``n_ticks``.

    A driver's buffer after its event e stays current until its next event,
    so it is judged at every tick in [e, next) -- or up to the last event of
    the stream if the driver sends nothing more.  This run-length form holds
    the same information as one row per tick in O(states) rows.
    """
    rolled = rolling_features(df, n, seq, chunk_size).withColumn(
        "risk_intensity_raw", F.col("risk_event_count") / F.col("event_count")
    )
    decided = rolled.withColumn(
        "decision_type",
        window_decision_type(
            "risk_score_window", "phone_usage_count", "event_count", "risk_intensity_raw", "risk_event_count", "km_window"
        ),
    ).filter(F.col("decision_type").isNotNull())
    last_seq = df.agg(F.max(seq)).scalar()  # scalar subquery: the stream's last event number
    ranges = (
        decided.withColumn("_upto", F.coalesce(F.col("next_seq") - F.lit(1), last_seq))
        .withColumn("first_tick", F.expr(f"(({seq} + {every} - 1) div {every}) * {every}"))
        .withColumn("last_tick", F.expr(f"(_upto div {every}) * {every}"))
        .filter(F.col("first_tick") <= F.col("last_tick"))
        .withColumn("n_ticks", F.expr(f"(last_tick - first_tick) div {every} + 1"))
    )
    return ranges.withColumns(rolling_decision_columns()).select(
        "first_tick",
        "last_tick",
        "n_ticks",
        "decision_source",
        "decision_ts",
        "driver_id",
        "decision_type",
        "priority",
        "recommended_action",
        "customer_message",
        "event_count",
        F.round("km_window", 4).alias("km_driven"),
        "risk_event_count",
        "risk_score_window",
        F.round("risk_intensity_raw", 3).alias("risk_intensity"),
        "phone_usage_count",
    )


def tick_decisions(
    df: DataFrame, first: int, last: int, n: int = 12, every: int = 10, seq: str = "event_no", chunk_size: int | None = None
) -> DataFrame:
    """The decisions at the ticks from ``first`` to ``last``: one row per tick and driver with a decision.

    The expanded form of ``tick_decision_ranges`` for a stated span of ticks.
    A driver that stops sending repeats its last decision at every later tick,
    so the whole stream's expansion would grow with the square of its length;
    the ranges hold the same information in one row per state.
    """
    ranges = tick_decision_ranges(df, n, every, seq, chunk_size)
    low, high = -(-first // every) * every, last // every * every
    inside = ranges.filter((F.col("first_tick") <= high) & (F.col("last_tick") >= low))
    span = F.sequence(F.greatest(F.col("first_tick"), F.lit(low).cast("long")), F.least(F.col("last_tick"), F.lit(high).cast("long")), F.lit(every).cast("long"))
    return inside.withColumn("tick", F.explode(span)).select("tick", *TICK_PAYLOAD)


def demo_decisions(flagged: DataFrame, n: int = 12, every: int = 10, seq: str = "event_no", chunk_size: int | None = None) -> DataFrame:
    """All decisions of the count-window policy in one output, with ``at_event``, the event number they are first taken at.

    Per event (every nudge high), and per buffer state with the last tick it
    is repeated at and the number of ticks.
    """
    events = _event_rows_with_seq(flagged, seq)
    ranges = tick_decision_ranges(flagged, n, every, seq, chunk_size).withColumnRenamed("first_tick", "at_event")
    return events.unionByName(ranges, allowMissingColumns=True)


def with_sequence(events: DataFrame, *order: str, name: str = "event_no") -> DataFrame:
    """``events`` with their exact place (from 1) in ``order``: a range sort, then partition offsets (one small row each).

    The offsets are broadcast up to ``MOST_OFFSETS`` partitions, and joined by shuffle beyond.
    """
    placed = events.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("_part", F.shiftright("_place", 33)), "sequence")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    shifts = sizes.select("_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    shifts = materialize(shifts, "sequence_offsets")
    shifts = F.broadcast(shifts) if shifts.count() <= MOST_OFFSETS else shifts
    return placed.join(shifts, "_part").withColumn(name, F.col("_place") + F.col("_shift")).drop("_place", "_part", "_shift")


def _event_rows_with_seq(flagged: DataFrame, seq: str) -> DataFrame:
    rows = build_event_decision_rows(flagged.withColumnRenamed(seq, "at_event"), "demo", extra=("at_event",))
    return rows.select("at_event", *DEMO_EVENT_DECISION_FIELDS)
