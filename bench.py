"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up run, then the median of ``$BENCH_REPEAT`` (default 3)
timed runs. Every run executes the whole plan into the ``noop`` sink (nothing is
collected to the driver). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "slot_sales_wide",
    "grid_interval",
    "calendar_features",
    "level_rollup_day",
    "level_rollup_interval",
    "correlation_long",
    "rolling_mean_21",
    "ema_span7",
    "naive_metrics",
    "expanding_folds",
    "reconcile_ols",
    "reconcile_mint_shrink",
    "reconcile_fitted_ols",
    "bootstrap_intervals",
    "recon_method_compare",
    "shrinkage_lambda",
    "impute_top7_variant_a",
    "seasonal_forecast",
    "seasonal_cv",
    "best_run",
    "run_metrics",
    "lookup_response",
    "lookup_reconciled",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from slotcast.plans import registry
    from slotcast.session import get_session

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, 2 * int(cpus)))))
    spark = get_session(f"local[{cpus}]", app="slotcast-bench", shuffle_partitions=shuffle)
    registry.load_all()
    names = only or HEADLINE
    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = registry.QUERIES[name]
        try:
            runs = []
            for i in range(repeat + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i > 0:                       # first run is the warm-up
                    runs.append(time.perf_counter() - t0)
            timings[name] = round(statistics.median(runs), 3)
        except Exception as e:  # noqa: BLE001 - report and keep benchmarking the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "repeat": repeat,
        "shuffle_partitions": shuffle,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
