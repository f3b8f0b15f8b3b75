"""Benchmark: run the headline queries and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_SHUFFLE_PARTITIONS
(default 2 x cpus),
BENCH_QUERIES (comma list, default the headline set below).

Each query is executed to completion through the ``noop`` sink (every row
is computed, nothing is collected to the driver) and timed on the wall
clock. Before timing, the same queries run once on the smallest fixture
folder (BENCH_WARMUP_DIR, default ``sf0.001`` next to BENCH_SF_DIR) so that
JIT, generated-code and Python-worker start-up are not billed to the first
query; the JSON records which folder warmed up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from switchboard import registry  # noqa: E402
from switchboard.session import build_session  # noqa: E402

HEADLINE = [
    # the sixteen warehouse views
    "org_hierarchy", "active_agents_ndv", "csat_rollup", "call_driver_regex", "repeat_contact_window",
    "billing_reconciliation", "agent_roster_current", "agent_scorecard", "attrition_risk",
    "queue_sla_attainment", "first_contact_resolution", "occupancy_utilization", "shrinkage_analysis",
    "program_margin", "client_executive_summary", "queue_hourly",
    # layered queries and cross-layer joins
    "csat_rollup_layered", "agent_scorecard_layered", "queue_hourly_layered", "xjoin_staging", "xjoin_ods", "xjoin_dm",
    # heavier layer transforms
    "cdc_delta_merge", "scd2_build", "ivr_sessionize", "queue_interval_rollup", "dim_agent_build", "keyword_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, cpus * 2)))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=parts, app_name="switchboard-bench")
    qs = registry.queries()
    warm = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.001"))
    if warm and os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for name in names:
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    else:
        warm = None
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]:.3f}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None,
                      "warmup": os.path.basename(warm) if warm else None}))
    spark.stop()


if __name__ == "__main__":
    main()
