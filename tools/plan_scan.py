"""Print the physical-plan operators of every registered query that would
not scale: single-partition exchanges, cartesian products, nested-loop
joins, Python evaluation. Usage: python tools/plan_scan.py [sf_dir] [names]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from widetab.plans.registry import load_all  # noqa: E402
from widetab.session import local_session  # noqa: E402

FLAGS = ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
         "ArrowEvalPython", "Generate explode", "TakeOrderedAndProject", "CollectLimit")


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.001"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    reg = load_all()
    spark = local_session()
    for name in args or sorted(reg):
        try:
            df = reg[name].build(spark, sf_dir)
            plan = df._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # noqa: BLE001
            print(f"{name}: error {e}")
            continue
        hits = sorted({f for f in FLAGS if f in plan})
        scans = plan.count("FileScan") + plan.count("Scan parquet")
        print(f"{name}: exchanges={plan.count('Exchange')} scans={scans} {' '.join(hits)}")


if __name__ == "__main__":
    main()
