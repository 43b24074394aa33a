"""Time the queries: one JSON line on stdout.

BENCH_SF_DIR   data folder   (default /root/testdata/sf0.1)
BENCH_CPUS     local cores   (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline list below)
BENCH_RUNS     timed runs per query after one warm-up (default 2, the median counts)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from stallbook.plans import registry
from stallbook.session import local_session


HEADLINE = (
    "sales_fact orders_rolled_up dwell_by_city sales_by_category daily_finance monthly_pl category_performance "
    "weekly_trend discount_roi payment_mix product_performance inventory_health returns_breakdown return_rate "
    "supplier_scorecard abc_pareto brand_performance category_affinity member_summary rfm_features rfm_segments "
    "cohort_retention city_sales clv churn_risk price_sensitivity nps_segments inactivity_histogram association_rules "
    "daily_events channel_attribution support_summary weekday_hour_heatmap funnel_conversion executive_kpis live_kpis "
    "recent_orders minute_trend category_rules gold_finance_pl sliding_kpis latest_months latest_rfm order_line_sample sliding_rate stream_orders_by_minute "
    "stream_deduplicated"
).split()


def timed(query, spark, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    queries = registry.queries()
    asked = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    names = list(queries) if asked == ["all"] else asked or HEADLINE

    spark = local_session(cpus, app="stallbook-bench")
    seconds: dict[str, float] = {}
    for name in names:
        timed(queries[name], spark, folder)
        seconds[name] = round(statistics.median(timed(queries[name], spark, folder) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
