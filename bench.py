"""Benchmark the headline queries.

Runs each query's full plan into Spark's ``noop`` sink (everything is
computed, nothing is collected) at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line.
Before timing, the JVM is warmed by running every headline query once on
the smallest tables (sf0.001): JIT and codegen paths are hot, yet no
measured input is read ahead of its query and every query fits its own model.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ladle.plans import queries  # noqa: E402
from ladle.session import build_session  # noqa: E402

HEADLINE = [
    "shelves_top5",        # Q12 storefront shelves
    "review_features",     # Q4 cleaned reviews joined to recipe features
    "category_mean",       # Q3 EDA joined report
    "describe_reviews",    # Q1 EDA statistics
    "author_vectors",      # A1 + M6 author profile vectors
    "next_recipe",         # W1 + W2 next-recipe sequences (skew-safe)
    "suggestions",         # Q7 neighbour suggestions with score
    "suggestions_reviews", # Q7 on the larger log
    "als_rmse",            # Q8 ALS fit + held-out RMSE
    "als_top5_wide",       # Q9 top-5 recipes for every author
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", 2 * cpus)),
                          extra={"spark.driver.memory": "16g"})
    qs = queries()
    # Warm-up outside the timings (JIT, codegen, Python workers) on tiny tables.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    warmed = os.path.isdir(warm_dir)
    if warmed:
        for name in HEADLINE:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and keep the JSON line
            print(f"bench: {name} failed: {type(e).__name__}: {e}", file=sys.stderr)
            times[name] = None
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    done = [t for t in times.values() if t is not None]
    print(json.dumps({"metric": "headline_total", "value": round(sum(done), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "warmup": f"each headline query once on {warm_dir}" if warmed else "none",
                      "failed": [k for k, v in times.items() if v is None]}))
    spark.stop()


if __name__ == "__main__":
    main()
