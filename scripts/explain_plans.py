"""Write PLANS.md: the physical plans of the key queries, with what to look for in each.

    python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadlens import config as C  # noqa: E402
from roadlens.operators import pricing as P  # noqa: E402
from roadlens.operators import reports as R  # noqa: E402
from roadlens.operators import rolling as RL  # noqa: E402
from roadlens.plans import REGISTRY  # noqa: E402
from roadlens.plans import inputs as I  # noqa: E402
from roadlens.session import build_session, materialize  # noqa: E402

NOTES = {
    "features_tumbling_1m": "One scan of 3 of the 6 source columns, one codegen'd projection, partial HashAggregate, one Exchange hashed on (driver_id, window), final HashAggregate.",
    "features_sliding_5m": "As above with an Expand (5 windows per row) before the partial aggregate: the shuffle carries partial rows per (driver, window), not raw rows.",
    "window_decisions": "The decision rule chain is a Filter + Project after the final aggregate: no extra shuffle.",
    "rolling_last_n_features": "One plan for every size. The chunk list (partial count per driver and bucket, running sum) is joined with the events by an equi-join left to AQE. Tails via WindowGroupLimit (partial before the shuffle), halo targets by lead over the tails, union, one bounded RowFrame(-11, 0) window per (driver, chunk). With an empty list AQE drops the halo branch.",
    "premium_score": "Per-driver roll-up (partial aggregate), prediction as column arithmetic, the mean frequency as a scalar Subquery (no join).",
    "latest_premium (one driver)": "The driver filter reaches the parquet scan (PushedFilters on the FileScan); max(struct) aggregate with a partial step before the shuffle (sort-based: the struct holds strings).",
    "premium lookup in the snapshot": "One bucket of 16 is selected; no shuffle. (Spark's automatic choice of bucketed scans is off here, as the plan shows the buckets only then.)",
    "merge of a run into the snapshot": "The old snapshot is read by bucket and meets the run in a full outer join: only the run's rows pass an Exchange.",
    "top-up of the roll-up": "PartitionFilters: only periods from the last known one on are read; partial sums before the Exchange.",
    "premium_trajectory_top5": "Top-k (TakeOrderedAndProject) of latest premiums, broadcast (k rows) into a left-semi join over the history.",
}


def strip_ids(text: str) -> str:
    return re.sub(r"#\d+L?", "", text)


def plan_of(df) -> str:
    return strip_ids(df._jdf.queryExecution().executedPlan().toString())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    flagged = I.flagged_events(spark, sf_dir)
    history = I.premium_history(spark, sf_dir)
    history_path = materialize(history)
    frames = {
        "features_tumbling_1m": REGISTRY["features_tumbling_1m"](spark, sf_dir),
        "features_sliding_5m": REGISTRY["features_sliding_5m"](spark, sf_dir),
        "window_decisions": REGISTRY["window_decisions"](spark, sf_dir),
        "rolling_last_n_features": RL.rolling_features(flagged, 12),
        "premium_score": P.score(P.driver_rollup(P.prepare_features(I.pricing_features(spark, sf_dir))), C.COMMITTED_COEFFICIENTS),
        "latest_premium (one driver)": None,
        "premium_trajectory_top5": R.trajectory(history_path, 5),
    }
    from roadlens.session import scratch_path
    from roadlens.sources import io as IO

    path = scratch_path(spark, "plans") + "/premium_history"
    IO.append_history(history, path)
    frames["latest_premium (one driver)"] = P.latest_premium(IO.load_history(spark, path), "D0002")

    from pyspark.sql import functions as F
    from roadlens.sources import premium_snapshot as PS
    from roadlens.sources import rollup_store as RS

    at = scratch_path(spark, "plans")
    runs = I.premium_runs(spark, sf_dir)
    PS.merge_run(runs[0], f"{at}/snapshot", buckets=16)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    frames["premium lookup in the snapshot"] = PS.lookup(spark, f"{at}/snapshot", "D0002")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a snapshot and a run of any size
    frames["merge of a run into the snapshot"] = PS.merged(PS.read_snapshot(spark, f"{at}/snapshot"), runs[1])
    plans = {name: plan_of(df).rstrip() for name, df in frames.items() if "snapshot" in name}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    features = I.pricing_features(spark, sf_dir).withColumn("window_hour", F.date_format("window_start", "yyyy-MM-dd'T'HH"))
    features.write.partitionBy("window_hour").parquet(f"{at}/features")
    RS.partials(RS.load_features(spark, f"{at}/features").filter("window_hour <= '2026-01-01T01'"), "window_hour").write.partitionBy("window_hour").parquet(f"{at}/rollup")
    frames["top-up of the roll-up"] = RS.partials(RS.new_periods(spark, f"{at}/features", f"{at}/rollup", "window_hour"), "window_hour")

    out = [
        "# Physical plans of the key queries",
        "",
        f"Generated by `scripts/explain_plans.py` at `{sf_dir}` (expression ids removed). "
        "Plans are the ones Spark builds before adaptive re-planning (AQE may still coalesce partitions or switch join strategies at run time).",
        "",
    ]
    for name, df in frames.items():
        out += [f"## {name}", "", NOTES[name], "", "```", plans.get(name) or plan_of(df).rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
