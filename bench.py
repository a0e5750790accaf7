"""Headline queries, one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores.

Every query is built and run into the noop sink in a warm session; the figure is
the median of three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from cartwright.session import build_session
from workload.queries import QUERIES

HEADLINE = [
    "c1_enrich_orders",
    "c1_enrich_carts",
    "c2_order_analytics",
    "c3_customer_analytics",
    "a7_segment_summary",
    "a8_payment_revenue",
    "w1_dominant_category",
    "w2_last_per_key",
    "j2_orphan_orders",
    "l1_top_customers",
    "p10_search",
    "g5_products",
    "x6_dominant_category",
    "k4_upsert",
    "k5_order_documents",
    "k6_kv_items",
    "k9_order_contract",
]


def timed(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("cartwright-bench", master=f"local[{cpus}]", conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    timed(QUERIES["c3_customer_analytics"], spark, sf_dir)  # warm-up
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(
            statistics.median(timed(QUERIES[name], spark, sf_dir) for _ in range(3)), 3
        )
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    line = {
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": float(sf_dir.rstrip("/").rpartition("sf")[2] or 0),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
