"""Census of the plans that really ran, per registered query -> PLANS.md.

Every query runs once into the ``noop`` sink with Spark's event log on. All SQL
executions of a query count, also those it starts while it is being built
(tables written to shared storage and read back), each with its final adaptive
plan. Dimension tables are built before, by the flagship query.

    python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tidewater.plans.registry import QUERIES  # noqa: E402
from tidewater.session import build_session  # noqa: E402

COLS = ["executions", "fact_scans", "shuffles", "range_shuffles", "broadcasts", "bhj", "smj", "windows", "sorts",
        "sort_aggregates", "python_nodes"]


def count(node: dict, c: Counter) -> None:
    name, text = node["nodeName"], node["simpleString"]
    if name.startswith("Scan parquet") and re.search(r"(events|lineitem)\.parquet", text + str(node.get("metadata"))):
        c["fact_scans"] += 1
    elif name == "Exchange":
        c["shuffles"] += 1
        c["range_shuffles"] += "rangepartitioning" in text
    elif re.search("Python|Pandas|Arrow", name) and "Columnar" not in name:
        c["python_nodes"] += 1
    else:
        kind = {"BroadcastExchange": "broadcasts", "BroadcastHashJoin": "bhj", "SortMergeJoin": "smj", "Window": "windows",
                "Sort": "sorts", "SortAggregate": "sort_aggregates"}.get(name)
        if kind:
            c[kind] += 1
    for child in node["children"]:
        count(child, c)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    log = tempfile.mkdtemp(prefix="plans-")
    SparkSession.builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{log}") \
        .config("spark.eventLog.rolling.enabled", "false").config("spark.sql.maxMetadataStringLength", "2000")
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["obs_per_datastream"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spans = []
    for name in sorted(QUERIES):
        began = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spans.append((name, began, time.time()))
    spark.stop()
    plans, starts = {}, {}
    for f in os.listdir(log):
        for line in open(os.path.join(log, f)):
            e = json.loads(line)
            if "sparkPlanInfo" in e:
                plans[e["executionId"]] = e["sparkPlanInfo"]         # the last one is the final plan
                starts.setdefault(e["executionId"], e.get("time", 0) / 1000)
    rows = []
    for name, began, ended in spans:
        c = Counter()
        for k, plan in plans.items():
            if began <= starts[k] <= ended:
                c["executions"] += 1
                count(plan, c)
        rows.append(f"| `{name}` | " + " | ".join(str(c[x]) for x in COLS) + " |")
    head = ["# Plans per query", "", f"Generated by `tools/plan_report.py` on `{sf_dir}`: final adaptive plans, summed over all SQL executions of a",
            "query, the tables it writes to shared storage included. Dimension tables are built before. `fact_scans` are scans of",
            "`events` or `lineitem`; a plan that uses the mapped fact several times scans it once and rereads narrow columns.", "",
            "| query | " + " | ".join(COLS) + " |", "|---" * (len(COLS) + 1) + "|"]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as out:
        out.write("\n".join(head + rows) + "\n")


if __name__ == "__main__":
    main()
