"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

Each query runs once to warm code generation and file listing, then ``BENCH_RUNS`` times; the
median counts. Results are written to the no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyflow.plans.catalog import QUERIES  # noqa: E402
from tallyflow.session import build_session  # noqa: E402

HEADLINE = (
    "b1_parse_usage", "b5_quarantine", "c1_dedup_events", "c1_dedup_order_lines", "c2_merge_fixed", "c6_customer_history",
    "c8_rate_versions", "d1_daily_usage", "d4_monthly_order_cost", "d7_having_repeated_key", "e3_daily_cost_asrun",
    "e5_plan_aware_cost", "e6_point_in_time_customer", "f1_close_headers_plan_aware", "f4_lines_by_rate", "f6_model_order_lines",
    "f8_audit_trail", "g1_late_events", "g4_adjusted_headers", "h3_pricing_coverage", "h4_invoice_integrity",
    "j1_dashboard_fixed", "j6_usage_report", "j6_order_usage_report", "k10_usage_matrix",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "tallyflow-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
