"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS how often each query runs (the best counts).
Every query is run to its full result through the noop sink, so nothing is fetched to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlens.plans import QUERIES  # noqa: E402
from orderlens.session import build_session  # noqa: E402

HEADLINE = [
    "agg_01_customer_stats", "agg_02_product_stats", "agg_04_processing_metrics", "agg_06_all_views",
    "agg_08_validation_stats", "agg_10_global_stats", "agg_12_store_stats", "win_01_consecutive_duplicates",
    "reg_02_version_steps", "reg_03_order_updates", "reg_04_registered_orders", "rul_09_validate_order",
    "rul_11_failures_per_rule", "rul_14_validate_command", "spec_10_violation_counts", "joi_01_timeline_with_status",
    "joi_02_order_search", "ded_02_last_per_order", "tml_01_timeline_ring", "top_01_customers_by_spent",
    "src_04_decode_aggregation", "src_07_decode_envelope", "snk_01_orders_to_topic", "snk_04_upsert_customers",
    "sca_07_parse_numbers", "str_01_orders_to_views", "str_02_two_hops", "str_04_stateful_products",
]


def timed(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 12g pyspark-shell")
    spark = build_session(f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, "agg_05_accepted_revenue", sf_dir)     # start-up, not counted
    seconds = {name: round(min(timed(spark, name, sf_dir) for _ in range(runs)), 3) for name in names}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
