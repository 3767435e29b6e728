"""Times stage builds, headline queries and one full run; prints one JSON line.

The stage tables are built from the raw tables under their own ``build_*``
entries; the queries then read them, as they would after a full run. Queries
that start from the raw tables do so here too.

The full run takes part name and brand for a product: 1 600 products and about
4 M product-days, the order of size that the reference's own figure has.
BENCH_WIDE=0 takes the part name alone, as the queries do: 25 times fewer.
BENCH_QUERIES (comma-separated names) limits the run to some queries.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import warnings

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
warnings.filterwarnings("ignore")

from checks.queries import QUERIES  # noqa: E402
from checks.shop import Shop  # noqa: E402
from larder.plans.full_run import Settings, full_run  # noqa: E402
from larder.operators.calendar import date_span  # noqa: E402
from larder.session import local_session  # noqa: E402
from larder.sources import tpch  # noqa: E402

STAGES = ("buyer_tx", "sales", "products", "stock", "history", "model_table")

HEADLINE = (
    "clean_tx", "quality_overview", "daily_agg", "promo_flag", "sku_profile", "calendar",
    "sales_daily_agg", "sales_weekly_agg", "category_agg", "top_skus", "promo_impact",
    "seasonality_pivot", "revenue_trend", "exec_kpis", "lag_features", "rolling_features",
    "ewma_features", "momentum_features", "trend_slope", "feature_table", "low_stock_alerts",
    "inventory_kpis", "risk_scores", "risk_every_day", "top_recommendations",
    "business_impact", "seasonal_naive", "forecast_metrics", "forecast_summary", "rf_forecast",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, os.environ.get("BENCH_MEMORY", "16g"))
    wanted = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE

    tpch.table(spark, folder, "lineitem").count()  # starts the session
    seconds = {}
    shop = Shop(spark, folder)
    for stage in STAGES:
        begin = time.perf_counter()
        getattr(shop, stage)
        seconds[f"build_{stage}"] = round(time.perf_counter() - begin, 3)
        print(stage, seconds[f"build_{stage}"], file=sys.stderr, flush=True)
    for name in wanted:
        begin = time.perf_counter()
        df = QUERIES[name].build(shop)
        df.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)

    details = {}
    if not os.environ.get("BENCH_QUERIES"):
        begin = time.perf_counter()
        wide = os.environ.get("BENCH_WIDE", "1") == "1"
        raw = tpch.invoice_lines(spark, folder, by_brand=wide)
        summary = full_run(
            raw, tpch.supply_terms(spark, folder, wide), tempfile.mkdtemp(prefix="larder-bench-"),
            Settings(cleaning=tpch.RULES),
            holidays=tpch.holidays(date_span(raw.select(raw.invoice_date.cast("date").alias("date")))),
        ).first()
        seconds["full_run"] = round(time.perf_counter() - begin, 3)
        rows = summary["sales_daily_rows"]
        details = {
            "full_run_sku_days": rows,
            "full_run_sku_days_per_second": round(rows / seconds["full_run"], 1),
            "best_model": summary["best_model"],
        }
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": cores, **details,
    }))


if __name__ == "__main__":
    main()
