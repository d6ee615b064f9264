"""Benchmark the headline plans.

Runs each plan at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up, then the median of three timed runs.
A run builds the plan (including its bounded driver-side checks) and
executes it fully into the ``noop`` sink, so no result is collected.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from periodfact.plans import queries  # noqa: E402
from periodfact.session import get_session  # noqa: E402

HEADLINE = [
    "period_fact", "family_union", "mean_by_period", "sum_all_by_period", "row_total_by_period",
    "lag_change_by_segment", "spine_left_join", "parse_locale_number", "unpivot_blocks",
    "unpivot_layouts", "tally_items", "lookup_first", "lookup_casefold", "unmatched_codes",
    "category_shares", "winner_item_category", "features_filled", "holdout", "oversample_rows",
    "knn_predict", "model_scores", "period_slice", "wide_files_fact",
]


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "16g"})
    qs = queries()
    times: dict[str, float] = {}
    for name in names:
        fn = qs[name]
        run_once(spark, fn, sf_dir)  # warm-up
        times[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(repeats)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus, "repeats": repeats}))


if __name__ == "__main__":
    main()
