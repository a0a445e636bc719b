"""Benchmark the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line. Each query is executed in full through the ``noop``
sink (nothing is collected to the driver), once to warm up and then
$BENCH_RUNS times (default 5); the reported time is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from medley.plans.queries import QUERIES  # noqa: E402
from medley.session import build_session  # noqa: E402

HEADLINE = [
    "parquet_scan",            # S1 full scan through the positional binding
    "sum_by_group",            # R8 filtered/aggregated scan
    "flagship_median_summary",  # S2+S5+R3+R8+A3 in one query
    "inner_equi_join",         # R11 lineitem x orders
    "median_global",           # A1, rank selection (the one plan of every size)
    "median_global_builtin",   # the same by Spark's built-in aggregate
    "median_distributed",      # A6
    "median_by_group",         # A2, rank selection
    "median_by_group_builtin",  # the same by Spark's built-in aggregate
    "median_rank_by_group",    # A7
    "resource_report",         # M20 two-level carry + rates
    "status_snapshot",         # M12
    "log_parse",               # M14 + M16
]


def _builtin(keys):
    """The built-in median over the same table, for comparison."""
    from medley.operators.median import median
    from medley.plans.given import table
    return lambda spark, sf: median(table(spark, sf, "lineitem"), "l_extendedprice", keys, strategy="builtin")


EXTRA = {"median_global_builtin": _builtin([]), "median_by_group_builtin": _builtin(["l_returnflag"])}


def run(spark, key, sf):
    fn = EXTRA.get(key) or QUERIES[key][0]
    t = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]
    spark = build_session(f"local[{cpus}]", app="medley-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "8g")})
    times = {}
    for key in keys:
        run(spark, key, sf)                       # warm-up
        times[key] = round(statistics.median(run(spark, key, sf) for _ in range(runs)), 4)
    label = os.path.basename(sf.rstrip("/"))
    print(json.dumps({"metric": "headline_total_median_of_%d" % runs,
                      "value": round(sum(times.values()), 4), "unit": "sec",
                      "queries": times, "sf": label.replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()
