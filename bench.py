"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up, then three times; the reported time is the
median, with the result fully computed into Spark's no-op sink (no
collection to Python).  ``value`` is the sum of the medians.  Staging queries
and scans start from the given tables.  Marts, reports and reads start from the
stored layer below them, as they do in the batch pipeline (``Served`` and
``two_day_run`` in ``plans.queries``): the warm-up run writes those layers, the
timed runs read them; ``setup`` is the time that writing took.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketmarts.plans.queries import QUERIES, two_day_run  # noqa: E402
from marketmarts.session import build_session, scratch_scope  # noqa: E402

HEADLINE = [
    "salary_cells_exact",
    "postings_staged",
    "companies_dim",
    "skill_demand",
    "company_activity",
    "top_skills_family",
    "weekly_pivot",
    "salary_kpis",
    "posting_search",
    "skills_theta_join",
    "board_b_map",
    "raw_scan_valid",
    "stream_hourly",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    # Small post-shuffle partitions still carry regex-heavy work at this scale,
    # so AQE may coalesce down to 64 KiB partitions instead of 1 MiB (no effect
    # once partitions are large).
    spark = build_session(f"local[{cpus}]", cpus, app="marketmarts-bench", extra={
        "marketmarts.scanPartitions": str(cpus),  # the tables are one row group each
        "spark.driver.memory": "16g",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    })
    t0 = time.perf_counter()
    two_day_run(spark, sf_dir)
    setup = time.perf_counter() - t0
    times = {}
    for name in names:
        q = QUERIES[name]
        runs = []
        for i in range(4):
            t0 = time.perf_counter()
            with scratch_scope(spark):
                q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "setup": round(setup, 3),
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
