"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is fully executed (written to a no-op sink via count of the
materialised result) in one session; the value is the total wall time.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "golden_v1", "history_v1", "steward_queue_v1",
    "cluster_one_hop", "cluster_transitive", "golden_v2", "history_v2", "address_golden", "customer_360",
    "reresolve_all", "golden_nrt", "cluster_incremental", "cdc_golden_events",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from aurum.plans.catalog import load_all
    from aurum.session import local_session

    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) * 2)
    reg = load_all()
    times: dict[str, float] = {}
    t_all = time.time()
    for name in names:
        t0 = time.time()
        df = reg[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    total = round(time.time() - t_all, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else None}))
    spark.stop()


if __name__ == "__main__":
    main()
