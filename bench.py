"""Benchmark the headline report queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query's plan runs to completion into Spark's ``noop`` sink (the full
job executes, nothing is collected).  One untimed warm-up pass, then the
best of ``BENCH_REPEAT`` (default 2) timed passes per query.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "consolidate", "net_payout", "join_enrich", "inc_productivity", "inc_sp_orders", "pen_critical",
    "pen_critical_new", "builder", "dash_by_channel", "win_latest_ties", "payout_cards", "page",
    "search_any", "agg_count_distinct", "join_star", "src_html_table",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    from kpiloom.session import get_session
    from kpiloom.workloads import load_all

    spark = get_session("kpiloom-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    registry = load_all()
    names = [n for n in HEADLINE if n in registry]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        registry[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for n in names:  # warm-up: JIT, file listing caches, Python imports
        run(n)
    times = {n: round(min(run(n) for _ in range(repeat)), 3) for n in names}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
