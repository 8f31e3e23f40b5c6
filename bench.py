"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` (or those named; ``all``: every query) on ``$BENCH_SF_DIR`` (default sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
Each query is executed in full through the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabspark.plans import catalog  # noqa: E402
from tabspark.plans.flagship import flagship  # noqa: E402
from tabspark.session import local_session  # noqa: E402

HEADLINE = [
    "scan_examples", "permute_seeded", "split_train_head", "split_fraction", "linear_scale_all",
    "normalize_recipe", "quantile_bounds", "bucketize_all", "feature_cross", "describe_table",
    "corr_matrix", "histogram", "vocab_topk", "multi_hot", "embed_docs", "prefix_cap", "split_head_tail",
    "holdout_fitted", "auc_exact", "roc_curve", "evaluate_binary", "confusion_normalised", "linreg_2d",
    "learning_curve_linear", "linreg_multi", "logreg", "softmax_linear",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(catalog.queries())
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2), app="tabspark-bench")
    # JVM warm-up on the smallest tables (not timed).
    run(flagship(spark, "/root/testdata/sf0.001"))
    times: dict[str, float] = {}
    t_all = time.time()
    t = time.time()
    run(flagship(spark, sf_dir))
    times["flagship"] = round(time.time() - t, 3)
    for n in names:
        t = time.time()
        run(catalog.get(n).fn(spark, sf_dir))
        times[n] = round(time.time() - t, 3)
    total = round(time.time() - t_all, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
