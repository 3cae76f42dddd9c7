"""Times the headline queries and prints one JSON line.

Each query is executed in full (every row is computed and discarded by the ``noop`` sink).
"""

from __future__ import annotations

import json
import os
import time

from millsight.registry.spark_queries import QUERIES
from millsight.session import local_session

HEADLINE = (
    "gold_manufacturing_daily",
    "gold_factory_quality",
    "gold_product_quality",
    "gold_supplier_quality",
    "gold_defect_pareto",
    "bronze_valid",
    "bronze_quarantine",
    "bronze_event_valid",
    "ingestion_audit",
    "latest_record",
    "silver_fact_production",
    "silver_fact_quality_event",
    "bronze_to_gold_factory_quality",
    "ranked_contribution",
    "lot_concentration",
    "dataset_validation",
    "acceptance_report",
    "mix_vs_within",
    "rolling_fpy",
    "defect_contribution",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    QUERIES["daily_rollup"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
