"""Compare every registered query with its SQL oracle (local check).

usage: python tools_check.py [sf_dir] [name ...]
"""

import json
import sys
import time

from tabspark.plans import catalog
from tabspark.plans.oracle_check import compare, duckdb_connection
from tabspark.session import local_session

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(catalog.queries())
import os
if os.environ.get("VANILLA"):
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
else:
    spark = local_session(shuffle_partitions=8)
con = duckdb_connection(sf)
bad = 0
for n in names:
    q = catalog.get(n)
    t = time.time()
    try:
        if q.sql:
            r = compare(spark, sf, n, q.fn, q.sql, con)
            ok = r["rows_match"] and r["schema_match"] and r["hash_match"]
        else:
            rows = q.fn(spark, sf).count()
            r = {"name": n, "rows": rows, "rows_only": True}
            ok = rows >= 0
    except Exception as e:  # noqa: BLE001
        r = {"name": n, "error": repr(e)[:600]}
        ok = False
        if "invalidated" in repr(e) or "INTERNAL" in repr(e):
            con = duckdb_connection(sf)  # a fatal engine error invalidates the connection
    r["sec"] = round(time.time() - t, 2)
    if not ok:
        bad += 1
        print("FAIL", json.dumps(r, default=str)[:1500], flush=True)
    else:
        print("ok  ", n, r.get("rows"), r["sec"], flush=True)
print("failures:", bad, "of", len(names))
