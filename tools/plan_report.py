"""Physical-plan summary of every query of the library (initial plan, before AQE re-planning).

usage: python tools/plan_report.py [sf_dir]
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surveyspark.plans import registry  # noqa: E402
from surveyspark.session import get_spark  # noqa: E402

OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
       "BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window",
       "WindowGroupLimit", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "TakeOrderedAndProject",
       "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "Expand", "Generate"]

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = get_spark("local[2]")
print("| query | " + " | ".join(o.replace("Exchange ", "X:") for o in OPS) + " | scans | pushed |")
registry.load_all()
for name, fn in registry.QUERIES.items():
    try:
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
    except Exception as e:  # noqa: BLE001
        print(f"| {name} | error {e} |")
        continue
    counts = [len(re.findall(re.escape(o) + r"\b", plan)) for o in OPS]
    scans = len(re.findall(r"FileScan parquet", plan))
    pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", plan))
    print(f"| {name} | " + " | ".join(str(c) for c in counts) + f" | {scans} | {pushed} |")
