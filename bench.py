"""Time the headline queries, each twice: cold, and warm once its code is compiled; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradeloom.checks import registry  # noqa: E402
from tradeloom.session import build_session  # noqa: E402

HEADLINE = [
    "buyer_overview_metrics",
    "buyer_top_products",
    "buyer_top_suppliers",
    "buyer_top_categories",
    "seller_performance_overview",
    "seller_monthly_trends",
    "seller_quarterly_trends",
    "seller_product_line_breakdown",
    "seller_sales_time_series_day",
    "seller_top_selling_products",
    "seller_regional_distribution",
    "seller_order_analysis",
    "write_history",
    "platform_benchmarks_buyer",
    "platform_benchmarks_seller",
    "insight_documents",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start the engine before the clock
    cold: dict[str, float] = {}
    warm: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        for seconds in (cold, warm):
            started = time.perf_counter()
            registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_cold",
                "value": round(sum(cold.values()), 3),
                "unit": "sec",
                "queries": cold,
                "warm_value": round(sum(warm.values()), 3),
                "warm_queries": warm,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
