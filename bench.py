"""Headline-query benchmark: prints ONE JSON line.

Env: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_QUERIES`` (comma list, default the headline set).  Each query is run
to completion with the ``noop`` sink (full computation, nothing collected);
the time includes plan construction and any lineage checkpoints it makes.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["dedup_first", "street_reference", "supply_alert", "deed_trend", "deed_stats", "group_means",
            "summary_quantiles", "audience_profiles", "field_rules"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    from quadra.plans.queries import QUERIES
    from quadra.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="quadra-bench", **{"spark.sql.shuffle.partitions": str(int(cpus) * 2), "spark.sql.files.maxPartitionBytes": "2m"})
    # warm-up: JVM, codegen caches (not timed)
    QUERIES["sanity_trim"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
