"""Benchmark the headline queries.

On $BENCH_SF_DIR (default /root/testdata/sf0.1) in local[$BENCH_CPUS] mode:

1. ``build_layers``: raw driver tables -> staging, dimension and fact parquet
   tables in the checkpoint folder (the drop-and-create layer build);
2. every query of HEADLINE against those stored layers, as the marts and
   analyses run in production; ``key_violations`` reads the raw tables.

Each plan runs in full into Spark's no-op sink.  Prints one JSON line:
{"metric", "value" (sum of all seconds, layer build included), "unit",
"queries": {name: seconds}, "sf"}.  A query is timed from DataFrame
construction to the end of execution; repetitions go round-robin over the
queries and the best of $BENCH_REPEAT runs counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from returnscope.plans.layers import Warehouse  # noqa: E402
from returnscope.plans.registry import RAW_ONLY, RUNNERS  # noqa: E402
from returnscope.session import ensure_checkpoint_dir, local_session  # noqa: E402

HEADLINE = [
    "marts_kpi_daily",
    "marts_kpi_daily_naive",
    "marts_segments",
    "rr_before_after",
    "rr_segment_ab",
    "rr_ztest",
    "checkout_funnel_before_after",
    "d7_retention_cohorts",
    "quick_refund_share",
    "rr_by_registration_cohort",
    "cart_dropoff",
    "kpi_totals",
    "key_violations",
    "clean_text",
    "tfidf",
    "kmeans_assign",
]


def run(warehouse, name: str) -> float:
    t0 = time.perf_counter()
    df = RUNNERS[name](warehouse)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def build_layers(spark, sf_dir: str) -> tuple[float, str]:
    root = os.path.join(ensure_checkpoint_dir(spark), f"bench-layers-{uuid.uuid4().hex[:8]}")
    t0 = time.perf_counter()
    Warehouse.from_driver(spark, sf_dir).write_layers(root, comment_partitions=spark.sparkContext.defaultParallelism)
    return time.perf_counter() - t0, root


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "4"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(
        cpus,
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        app="returnscope-bench",
        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "12g"),
    )
    build_layers(spark, sf_dir)  # warm-up: JVM, code generation, file listing
    builds = [build_layers(spark, sf_dir) for _ in range(repeat)]
    times = {"build_layers": round(min(t for t, _ in builds), 3)}
    layered = Warehouse.from_layers(spark, builds[-1][1])
    raw = Warehouse.from_driver(spark, sf_dir)
    best: dict[str, float] = {}
    # round-robin repetitions: a slow moment of the machine hits one run of
    # many queries rather than every run of one query
    for _ in range(repeat):
        for name in names:
            w = raw if name in RAW_ONLY else layered
            best[name] = min(best.get(name, float("inf")), run(w, name))
    times.update({name: round(best[name], 3) for name in names})
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
