"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Every query runs once to
warm the engine up and is then timed; ``cold`` holds the first run's seconds.
"""

from __future__ import annotations

import json
import os
import time

from lendmill.plans.registered import QUERIES
from lendmill.session import local_session

HEADLINE = [
    "mart_loan_performance",
    "mart_customer_360",
    "npl_by_segment",
    "province_segment_heavy",
    "portfolio_kpis",
    "dq_gate",
    "column_tests",
    "dq_metrics",
    "scd2_apply",
    "scd2_history",
    "upsert_latest",
    "masked_engineer",
    "semantic_mixed_grain",
    "bm25_topk",
    "vector_topk",
    "ml_features",
    "ingest_good",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    cold = {n: seconds(spark, n, sf_dir) for n in names}
    warm = {n: seconds(spark, n, sf_dir) for n in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
