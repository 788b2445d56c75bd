"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

The derived tables (panel, order facts, backtest, ledger) are built once per session and timed as
`build_*`; the queries then run on what was written, as they would in production.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfline.plans.catalog import CATALOG  # noqa: E402
from shelfline.plans.data import Data  # noqa: E402
from shelfline.session import local_session, release  # noqa: E402

BUILDS = ("sold", "prices", "sales", "cleaned", "delivery", "backtest", "champion", "test", "future", "policy",
          "pretest_policy", "ledger", "kpis")
HEADLINE = (
    "i01_monthly_revenue", "i02_monthly_growth", "i03_store_ranking", "i04_category_contribution", "i05_top_items",
    "i07_rolling_demand", "i09_abc_by_item", "i11_abc_xyz_by_series", "i12_price_and_demand_changes", "i13_event_uplift",
    "a01_history_summary", "a02_period_rollups", "a03_dimension_profiles", "a04_price_demand_correlation",
    "w01_lags", "w03_rolling_spread_and_sums", "w05_days_since_last_sale", "w12_error_scale", "d04_segmentation",
    "d08_mart_sales_performance", "q06_panel_rules", "q04_table_profile",
    "i19_late_rate_by_mode", "i20_delay_by_region", "i22_loss_making_orders", "i23_big_sellers_with_low_margin",
    "i24_late_order_pareto", "o02_delivery_summary", "o04_profit_summary", "o05_order_profit", "d12_mart_profitability",
    "i14_wape_by_store", "b11_model_metrics", "b14_test_intervals", "b16_segment_metrics", "b18_production_forecast",
    "v06_policy", "v08_sensitivity", "v09_ledger", "v10_ledger_kpis", "i28_paired_cost_reduction", "k06_replay_measures",
    "k18_profit_decomposition", "i25_executive_kpis", "o10_recommendations",
    "b05_poisson_forecast", "b08_tree_forecast", "o07_risk_metrics", "o09_feature_importance",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    seconds: dict[str, float] = {}
    data = Data(spark, folder)
    for name in BUILDS:
        started = time.perf_counter()
        getattr(data, name)
        seconds[f"build_{name}"] = round(time.perf_counter() - started, 3)
    for name in HEADLINE:
        started = time.perf_counter()
        CATALOG[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    release(spark)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
