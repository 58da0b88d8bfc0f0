"""Physical-plan summary of every registered query of the lakehouse, written as markdown.

    python tools/plan_report.py [sf_dir] > PLANS.md

Broadcast joins are disabled, statically and adaptively, which gives the shape a query
has when every table is large.  All plans that a query runs are counted, also those of
the tables it writes on the way: they are read from Spark's event log, as they ended.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COLUMNS = ["plans", "hash shuffles", "reused", "range shuffles", "single-partition", "rebalance", "SMJ", "BHJ", "windows", "group limits", "top-k", "scans"]


def count(node: dict, out: Counter, keys: set) -> None:
    name, text = node["nodeName"], node["simpleString"]
    if name == "Exchange":
        kind = ("rebalance" if "REBALANCE" in text else "hash shuffles" if "hashpartitioning" in text
                else "range shuffles" if "rangepartitioning" in text else "single-partition" if "SinglePartition" in text else "rebalance")
        out[kind] += 1
        if kind == "hash shuffles":
            keys.add(re.sub(r"#\d+L?", "", re.search(r"hashpartitioning\((.*), \d+\)", text)[1]))
    names = {"ReusedExchange": "reused", "SortMergeJoin": "SMJ", "BroadcastHashJoin": "BHJ", "Window": "windows",
             "WindowGroupLimit": "group limits", "TakeOrderedAndProject": "top-k"}
    base = name.split("(")[0].strip()
    if base in names:
        out[names[base]] += 1
    if name.startswith("Scan ") and "ExistingRDD" not in name:
        out["scans"] += 1
    if base == "ReusedExchange":
        return
    for child in node["children"]:
        count(child, out, keys)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from ledgerlake.queries import QUERIES
    from ledgerlake.session import build_session
    logs = tempfile.mkdtemp(prefix="plan-report-")
    spark = build_session("local[8]", extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{logs}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false"})
    spans = []
    for name, fn in QUERIES.items():
        began = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        spans.append((name, began, time.time()))
    spark.stop()
    plans: dict[int, dict] = {}
    started: dict[int, float] = {}
    for line in next(Path(logs).iterdir()).open():
        event = json.loads(line)
        if "sparkPlanInfo" in event:
            plans[event["executionId"]] = event["sparkPlanInfo"]
            started.setdefault(event["executionId"], event.get("time", 0) / 1000)
    print("# Physical plans (broadcast joins disabled: the large-table shape)\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}`: sums over all plans that a query ran, "
          "those of its written steps included. `reused` counts shuffles read again by a second branch.\n")
    print("| query | " + " | ".join(COLUMNS) + " | hash-shuffle keys |")
    print("| --- | " + " | ".join("---" for _ in COLUMNS) + " | --- |")
    for name, began, ended in spans:
        out, keys = Counter(), set()
        for k, plan in plans.items():
            if began - 0.01 <= started[k] <= ended:
                out["plans"] += 1
                count(plan, out, keys)
        print(f"| {name} | " + " | ".join(str(out[c]) for c in COLUMNS) + " | " + "; ".join(f"`{k}`" for k in sorted(keys)) + " |")


if __name__ == "__main__":
    main()
