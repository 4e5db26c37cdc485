"""Time the headline queries: one JSON line with seconds per query.

``BENCH_SF_DIR`` names the test tables, ``BENCH_CPUS`` the cores. The pipeline's stored
tables are built first, each timed as ``build_*``; the queries then read them, as they do
in production. ``value`` is the sum of all of it. ``compare_*`` entries set a design
choice of this library against the direct form and are not part of the sum. The three
trainings, which fit all their rounds, are not timed, nor are the corpus queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from fleetpulse.operators import features, monitor, quality  # noqa: E402
from fleetpulse.session import local_session  # noqa: E402
from fleetpulse.testbed.queries import QUERIES, _typed_snapshots  # noqa: E402
from fleetpulse.testbed.tables import bed  # noqa: E402

HEADLINE = [
    "dq_results", "quarantine_critical", "good_rows", "upsert_two_batches", "promote_fact", "rolling_rate",
    "features_v1", "split_sizes", "eval_rul", "threshold_sweep", "metric_trend", "drift_log", "retraining_required",
    "latest_component_risk", "risk_ranking_top50", "aircraft_summary", "supplier_risk",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, action):
        start = time.time()
        action()
        seconds[name] = round(time.time() - start, 3)

    b = bed(spark, sf_dir)
    for table in ("staging", "dim_supplier", "dim_aircraft", "dim_component", "fact", "features"):
        timed(f"build_{table}", lambda table=table: getattr(b, table))
    for name in HEADLINE:
        timed(name, lambda name=name: run(QUERIES[name](spark, sf_dir)))
    total = round(sum(seconds.values()), 3)

    snapshots = _typed_snapshots(b)
    args = ("component_type", "snapshot_date", "failure_within_90_days")
    staged = features.rolling_rate(snapshots, *args)
    timed("compare_rate_two_stage", lambda: run(snapshots.join(F.broadcast(staged), ["component_type", "snapshot_date"])))
    timed("compare_rate_direct", lambda: run(features.rolling_rate_direct(snapshots, *args)))
    timed("compare_rules_one_pass", lambda: run(quality.run_checks(b.landed, quality.RULES, b.ctx)))

    def rule_by_rule():
        for rule in quality.RULES:
            quality.run_checks(b.landed, [rule], b.ctx).collect()

    timed("compare_rules_scan_each", rule_by_rule)
    timed("compare_drift_one_pass", lambda: run(monitor.drift(b.features, b.ctx)))

    def feature_by_feature():
        for feature in monitor.DRIFT_FEATURES:
            monitor.drift(b.features, b.ctx, features=[feature]).collect()

    timed("compare_drift_scan_each", feature_by_feature)

    print(json.dumps({
        "metric": "pipeline and headline queries", "value": total, "unit": "sec", "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
