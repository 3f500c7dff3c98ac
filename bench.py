"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query starts from the tables: trips are derived, keyed, deduplicated, measured and checked
before it can answer. Each is run to completion (all rows produced, none collected).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripflow import get_spark  # noqa: E402
from tripflow.plans import registry  # noqa: E402

HEADLINE = (
    "bronze_distribution", "trip_id", "dedup_trips", "dedup_stats", "suspicious_profile", "rejected_records",
    "quality_metrics", "quality_metrics_by_period", "gold_trips_clean", "gold_daily_revenue",
    "gold_location_performance", "v1_revenue_by_service", "v3_top_routes", "v5_rejection_reasons", "v6_top_days",
    "v7_suspicious_rate", "v8_date_integrity", "monthly_service_stats", "unique_trips", "rejection_share",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    registry.Flow(spark, sf_dir).bronze().limit(1).count()  # start the session's threads
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    line = {
        "metric": "total_headline_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
