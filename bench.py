"""Time the headline queries on whole tables; prints one JSON line.

Every query runs twice and the faster run counts, since the first one also compiles its code.
Results are computed in full and discarded.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rulecast.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "model_reach",
    "cluster_reach",
    "audience_not_recent",
    "tap_feedback",
    "event_feedback",
    "feedback_backfill",
    "control_devices",
    "success_devices",
    "feedback_devices",
    "daily_rules",
    "rules_one_day",
    "device_catalog",
    "match_catalog",
    "device_properties",
    "cluster_brand_rules",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    times = {name: round(min(run(spark, name, sf_dir) for _ in range(2)), 3) for name in HEADLINE}
    spark.stop()
    line = {
        "metric": "total of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
