"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line.

Each query is planned and run to completion into Spark's no-op sink. One run warms up code
generation and file caches, the second is timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import build_session  # noqa: E402
from verification.queries import QUERIES  # noqa: E402

HEADLINE = (
    "gold_daily_revenue",
    "gold_revenue_by_category",
    "gold_revenue_by_state",
    "gold_customer_satisfaction",
    "gold_seller_performance",
    "order_status_share",
    "silver_orders",
    "silver_order_items",
    "silver_order_payments",
    "silver_order_reviews",
    "silver_geolocation",
    "row_hash",
    "duplicate_check",
    "dup_key_conflicts",
    "null_check_a",
    "revenue_anomaly_days",
    "value_outliers_iqr",
    "dq_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/"))
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
