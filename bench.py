"""Benchmark: wall time of the headline queries at $BENCH_SF_DIR.

Each query runs to completion into the ``noop`` sink (full execution, no
collect), once to warm up and then three times; the median is reported.
Warm means the JVM, the Python workers and the run's dimension tables
(station / datastream catalogue, materialized once per session as a job
producing many outputs would) are ready; all fact-side work -- scans, joins,
hashing, shuffles, aggregates -- is executed again in every measured run.
Beside them, not in the total: a control query that none of our code touches (it
shows how fast the machine is), and single runs of queries over stored tables.
Prints ONE JSON line:

    {"metric": "median_query_wall_time_total", "value": N, "unit": "sec",
     "queries": {"q": sec, ...}, "sf": ..., "control": sec, "stored": {"q": sec, ...}}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans.registry import QUERIES  # noqa: E402
from tidewater.session import build_session  # noqa: E402

HEADLINE = [
    "map_observations", "obs_per_datastream", "reject_reasons", "batch_documents", "batch_resume",
    "period_stats", "obs_count_stats", "responsible_parties", "load_observations", "series_defaults",
    "duplicate_report", "dedup_first", "cascade_plan", "sorted_observations", "upsert_datastreams",
]
STORED = ["write_modes", "changed_files", "executed_cascade", "resumed_export"]


def control(spark, sf_dir):
    """Plain Spark over the same fact table."""
    t = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return t.groupBy("l_suppkey", "l_returnflag").count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", int(cpus))
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    names = [q for q in (only or HEADLINE) if q in QUERIES]
    out = {}

    def timed(query, warm: bool = True) -> float:
        spark.catalog.clearCache()       # every query starts from cold dimension tables
        times = []
        for i in range(runs + 1 if warm else 1):         # run 0 warms up (JVM, Python workers, dimension tables)
            t0 = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i or not warm:
                times.append(time.perf_counter() - t0)
        return round(statistics.median(times), 3)

    for name in names:
        out[name] = timed(QUERIES[name])
    more: dict = {} if only else {"control": timed(control), "stored": {}}
    for name in () if only else STORED:
        try:
            more["stored"][name] = timed(QUERIES[name], warm=False)
        except Exception as e:           # the total stands whatever happens beside it
            print(f"{name}: {e}", file=sys.stderr)
            more["stored"][name] = None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "median_query_wall_time_total", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": float(m.group(1)) if m else sf_dir, **more}))


if __name__ == "__main__":
    main()
