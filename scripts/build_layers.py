"""Build the stored layers (stg / dim / fact, and the two marts) from driver tables.

usage: python scripts/build_layers.py SF_DIR OUT_ROOT [--no-marts]
Runs on the active cluster session when one exists (spark-submit), otherwise on
a local session; prints the written table paths.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from returnscope.plans.layers import Warehouse  # noqa: E402
from returnscope.session import configure, local_session  # noqa: E402


def main() -> None:
    if len(sys.argv) < 3:
        raise SystemExit(__doc__)
    sf_dir, out_root = sys.argv[1], sys.argv[2]
    spark = SparkSession.getActiveSession() or local_session()
    configure(spark)
    written = Warehouse.from_driver(spark, sf_dir).write_layers(out_root, with_marts="--no-marts" not in sys.argv)
    for name, path in written.items():
        print(f"{name:28s} {path}")


if __name__ == "__main__":
    main()
