"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is built and fully executed (noop sink, no driver collect);
times include any small driver-side steps the operator needs (thresholds,
p-sized statistics). A query whose first run takes under REPEAT_UNDER seconds
runs three times and its median counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from widetab.plans.registry import load_all  # noqa: E402
from widetab.session import local_session  # noqa: E402

HEADLINE = [
    "column_profile", "top_values", "missing_share", "duplicate_rows_hashed",
    "encode_levels", "pooled_frequency_score", "parse_dates",
    "holdout_n", "stratified_folds", "every_nth", "bags",
    "auc_model_scores", "score_table", "progress",
    "average", "blend", "blend_weight_grid",
    "hash_features", "ftrl_two_steps",
    "pearson", "spearman",
    "boosted_scores", "stack_oof",
    "bagged_scores", "sweep_online", "stream_score_ftrl",
]
REPEAT_UNDER = 6.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="widetab-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    reg = load_all()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in reg]
    # Warm-up on the smallest scale (JIT, code generation); not timed.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for w in ("column_profile", "holdout_n", "auc_model_scores", "ftrl_two_steps", "stratified_folds"):
            reg[w].build(spark, warm_dir).write.format("noop").mode("overwrite").save()
    reg["row_count"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        runs = []
        while not runs or (len(runs) < 3 and runs[0] < REPEAT_UNDER):
            t0 = time.perf_counter()
            df = reg[name].build(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
