"""Wall-clock of the headline queries; prints one JSON line."""

import json
import os
import time

from icuqm import catalog
from icuqm.session import build_session

HEADLINE = [
    "adherence_cube",
    "asof_latest_view",
    "asof_view_within_4h",
    "carry_forward_2h",
    "lead_intervals",
    "split_by_day",
    "union_intervals",
    "qualifying_holds",
    "overlap_flag_day",
    "count_before_day",
    "attribute_events_day",
    "state_episodes",
    "flag_runs",
    "bookend_sessions",
    "persistence",
    "sum_of_steps",
    "hourly_scaffold",
    "stitched_stays",
    "cutoff_sweep",
    "mask_histogram",
    "exact_quantiles",
    "majority_unit_nested",
    "lpv_day_status",
    "sat_observation",
    "sbt_observation",
    "proning_eligibility",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("icuqm-bench", "UTC", f"local[{cores}]", cores)
    spark.sparkContext.setLogLevel("ERROR")
    known = catalog.queries()
    # one small query first, so that session start-up is not charged to a measured one
    known["top_values"](spark, folder).count()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": folder.rsplit("sf", 1)[-1]}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
