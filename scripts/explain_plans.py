"""Summarise the physical plans of the registered queries over stored layers.

usage: python scripts/explain_plans.py [sf_dir] [name ...]
For each query: shuffles (Exchange), broadcast / sort-merge / nested-loop joins,
windows and partial window-group limits, cartesian products, fact scans pruned to
the folders of some names, and the pushed filters of fact-table scans.  Plans are printed before execution (AQE may still
turn a sort-merge join into a broadcast at run time).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from returnscope.plans.layers import Warehouse  # noqa: E402
from returnscope.plans.registry import RAW_ONLY, RUNNERS  # noqa: E402
from returnscope.session import ensure_checkpoint_dir, local_session  # noqa: E402

# Queries that fit K-Means (iterative jobs) while their plan is built.
FITS_MODEL = {"kmeans_elbow", "kmeans_assign", "silhouette", "cluster_top_terms", "cluster_examples", "kmeans_checks"}


def summary(df) -> dict:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, re.M)
    count = {k: nodes.count(k) for k in set(nodes)}
    pushed = sorted(
        {
            m.strip()
            for m in re.findall(r"PushedFilters: \[(.*)\]", plan)
            if "date" in m and ("GreaterThan" in m or "LessThan" in m)
        }
    )
    return {
        "exchanges": count.get("Exchange", 0),
        "bhj": count.get("BroadcastHashJoin", 0),
        "smj": count.get("SortMergeJoin", 0),
        "bnlj": count.get("BroadcastNestedLoopJoin", 0),
        "cartesian": count.get("CartesianProduct", 0),
        "windows": count.get("Window", 0),
        "partial_limits": plan.count(", Partial\n"),
        "pruned_folders": len(re.findall(r"PartitionFilters: .*dynamicpruning", plan)),
        "pushed_date_filters": pushed,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or [n for n in RUNNERS if n not in FITS_MODEL]
    spark = local_session(8)
    root = os.path.join(ensure_checkpoint_dir(spark), f"explain-layers-{uuid.uuid4().hex[:8]}")
    Warehouse.from_driver(spark, sf_dir).write_layers(root)
    layered = Warehouse.from_layers(spark, root)
    raw = Warehouse.from_driver(spark, sf_dir)
    for name in names:
        s = summary(RUNNERS[name](raw if name in RAW_ONLY else layered))
        print(
            f"{name:30s} exch={s['exchanges']:2d} bhj={s['bhj']:2d} smj={s['smj']:2d} bnlj={s['bnlj']} "
            f"cart={s['cartesian']} win={s['windows']:2d} partial_wgl={s['partial_limits']} "
            f"pruned={s['pruned_folders']} "
            f"pushed={'; '.join(f[:90] for f in s['pushed_date_filters'])}"
        )


if __name__ == "__main__":
    main()
