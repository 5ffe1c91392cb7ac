"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads). Each query runs once to
warm up code generation and once timed; results are computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rule_split",
    "rule_counts",
    "type_transform",
    "currency_normalize",
    "lookup_surrogate_keys",
    "dq_transaction_suite",
    "quarantine_stats",
    "bronze_orphan_counts",
    "batch_summary",
    "revenue_summary",
    "customer_analytics",
    "merchant_analytics",
    "channel_performance",
    "geographic_summary",
    "daily_kpis",
    "monthly_kpis",
    "weekly_kpis",
    "new_vs_returning",
    "executive_summary",
    "dim_customer",
    "dim_account",
    "scd2_history",
    "sink_merge_upsert",
    "transform_transactions",
    "run_all_layers",
    "late_data",
]


def main() -> None:
    from ledgerloom.registry import QUERIES
    from ledgerloom.session import build_session
    from ledgerloom.sources import star

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # raw and fact layers are derived and stored on first use; that cost is shown on its own
    start = time.perf_counter()
    star.raw_transactions(spark, sf_dir)
    star.fact(spark, sf_dir)
    seconds = {"store_layers": round(time.perf_counter() - start, 3)}
    for name in names:
        run(name)
        seconds[name] = round(run(name), 3)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
