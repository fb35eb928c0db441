"""Scaling and skew check: derive larger event tables from the given one and time key queries.

    python scripts/scale_check.py [sf_dir] [factors...]

For factor R the `events` table is replicated R times by Spark (copy k gets
new event ids ``event_id * R + k`` and new users ``user_id + k * users``), so
the number of drivers grows with R.  The ``skew`` variant additionally gives
one driver a third of all rows.  The derived tables are written once to a
fresh folder under the shared checkpoint location; each query runs through
the ``noop`` sink.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from roadlens.operators import rolling as RL  # noqa: E402
from roadlens.plans import REGISTRY  # noqa: E402
from roadlens.plans.inputs import flagged_events  # noqa: E402
from roadlens.session import build_session, scratch_path  # noqa: E402

QUERIES = ("features_tumbling_1m", "features_sliding_5m", "window_decisions", "rolling_last_n_features", "impute_claim_count")


def derive(spark, sf_dir: str, factor: int, skew: bool, out: str) -> int:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    users = ev.agg(F.max("user_id")).first()[0] + 1
    copies = ev.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
    derived = copies.select(
        (F.col("event_id") * F.lit(factor) + F.col("k")).alias("event_id"),
        "ts",
        (F.col("user_id") + F.col("k") * F.lit(users)).alias("user_id"),
        "event_type",
        "value",
        "props",
    )
    if skew:  # one driver (users 0..5) gets every third event
        derived = derived.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    # many files, as a large table has (the given table is a single row group: one scan task)
    files = 2 * spark.sparkContext.defaultParallelism
    derived.repartition(files).sortWithinPartitions("event_id").write.mode("overwrite").parquet(f"{out}/events.parquet")
    return spark.read.parquet(f"{out}/events.parquet").count()


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    factors = [a for a in args if not a.startswith("/")] or ["1", "4", "16", "16skew"]
    spark = build_session()
    root = scratch_path(spark, "scale")
    REGISTRY["risk_flags"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    report = {}
    for f in factors:
        factor, skew = int(f.replace("skew", "")), f.endswith("skew")
        out = f"{root}/x{f}"
        rows = derive(spark, sf_dir, factor, skew, out)
        times = {}
        for name in QUERIES:
            t0 = time.perf_counter()
            REGISTRY[name](spark, out).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 2)
        # the same count windows with the hot-driver split forced (chunk = rows / 64)
        t0 = time.perf_counter()
        RL.rolling_features(flagged_events(spark, out), 12, chunk_size=max(1, rows // 64)).write.format("noop").mode(
            "overwrite"
        ).save()
        times["rolling_split_forced"] = round(time.perf_counter() - t0, 2)
        core = sum(times[q] for q in QUERIES)
        report[f] = {"rows": rows, "seconds": times, "total": round(core, 2), "us_per_row": round(core / rows * 1e6, 2)}
    print(json.dumps({"sf_dir": sf_dir, "report": report}))
    spark.stop()


if __name__ == "__main__":
    main()
