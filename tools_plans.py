"""Audit the physical plan and the rows read of every registered query.

usage: python tools_plans.py [sf_dir] > PLANS.md-table

Per query: parquet scans, hash/range shuffles, single-partition exchanges,
broadcast exchanges, joins by strategy, windows (and window functions without
a partition key), top-n heaps, cartesian products, Python stages, and
``rows_read``: the parquet/checkpoint records all of the query's jobs read
(from Spark's event log, written to a fresh scratch folder; job groups tag
each query). Plans are taken after a full ``noop`` run (AQE's final plan).
"""

import glob
import json
import os
import re
import sys
import tempfile

from pyspark.sql import SparkSession

from tabspark.plans import catalog
from tabspark.session import ensure_checkpoint_dir

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
ev = tempfile.mkdtemp(prefix="tabspark-ev-")
spark = (SparkSession.builder.master("local[8]").appName("tabspark-plans")
         .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", ev)
         .config("spark.eventLog.compress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
ensure_checkpoint_dir(spark)

COLS = ["scans", "shuffles", "single", "bcast", "smj", "bhj", "bnlj", "window", "window_nokey",
        "topn", "cartesian", "python"]
rows = {}
for name in catalog.queries():
    spark.sparkContext.setJobGroup(name, name)
    try:
        df = catalog.get(name).fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        p = df._jdf.queryExecution().executedPlan().toString()
    except Exception as e:  # noqa: BLE001
        rows[name] = {"error": type(e).__name__}
        continue
    # first item of each window spec: a partition key, or (no key) an ordering
    specs = re.findall(r"windowspecdefinition\(([^,)]*)", p)
    rows[name] = {
        "scans": len(re.findall(r"FileScan parquet", p)),
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning)", p)),
        "single": len(re.findall(r"Exchange SinglePartition", p)),
        "bcast": len(re.findall(r"BroadcastExchange", p)),
        "smj": len(re.findall(r"SortMergeJoin", p)),
        "bhj": len(re.findall(r"BroadcastHashJoin", p)),
        "bnlj": len(re.findall(r"BroadcastNestedLoopJoin", p)),
        "window": len(re.findall(r"\bWindow \[", p)),
        "window_nokey": sum(1 for w in specs if " ASC" in w or " DESC" in w),
        "topn": len(re.findall(r"TakeOrderedAndProject", p)),
        "cartesian": len(re.findall(r"CartesianProduct", p)),
        "python": len(re.findall(r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", p)),
    }
spark.stop()

stage_group, read = {}, {}
files = [f for f in glob.glob(ev + "/**", recursive=True) if os.path.isfile(f)]
for f in files:
    for line in open(f):
        e = json.loads(line)
        if e.get("Event") == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = g
        elif e.get("Event") == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            g = stage_group.get(e["Stage ID"])
            read[g] = read.get(g, 0) + (m.get("Input Metrics") or {}).get("Records Read", 0)

print("| query | rows_read | " + " | ".join(COLS) + " |")
print("|---|---|" + "---|" * len(COLS))
for name, r in rows.items():
    if "error" in r:
        print(f"| {name} | error: {r['error']} |")
    else:
        print(f"| {name} | {read.get(name, 0)} | " + " | ".join(str(r[c]) for c in COLS) + " |")
