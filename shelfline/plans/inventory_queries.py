"""Queries over policies and their replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import dimensions, policy, replay
from shelfline.plans import marts, reports
from shelfline.plans.data import Data
from shelfline.plans.query import Query
from shelfline.sources import testdata

_POLICY = (
    "safety_stock expected_lead_time_demand reorder_point protection_safety_stock order_up_to_level eoq days_of_supply "
    "inventory_value demand_uncertainty_std stockout_probability recommended_order_quantity excess_units excess_value forecast_daily_demand"
)
_ASSUMED = (
    "average_lead_time_days lead_time_standard_deviation ordering_cost_per_order annual_holding_cost_rate estimated_unit_cost "
    "initial_inventory review_period_days lost_sale_penalty minimum_order_quantity case_pack_size"
)
_LEDGER = (
    "opening_inventory arrivals forecast_demand actual_demand fulfilled_units lost_sales_units order_quantity in_transit_units "
    "closing_inventory holding_cost ordering_cost lost_sale_cost total_inventory_cost lost_sales_value"
)
_KPIS = (
    "actual_demand fulfilled_units lost_sales_units lost_sales_value average_inventory maximum_inventory holding_cost ordering_cost "
    "lost_sale_cost total_inventory_cost fill_rate cycle_service_level inventory_turnover baseline_cost baseline_lost_sales_value "
    "estimated_cost_reduction estimated_revenue_protected"
)
_COUNTS = "stockout_days completed_cycles successful_cycles days"
_WORLD = "item_id store_id policy scenario target_service_level run_id"


def _names(*groups: str) -> list[str]:
    return " ".join(groups).split()


def _sql(table: str, *groups: str, where: str = "true") -> str:
    return f"SELECT {', '.join(_names(*groups))} FROM {table} WHERE {where}"


def _assumed(d: Data):
    return policy.create_assumptions(d.history, d.settings)


def _overridden(d: Data):
    """Supplied values for one store replace the drawn lead time; other cells stay."""
    base = _assumed(d)
    supplied = base.select("item_id", "store_id", F.when(F.col("store_id") == "S_1", 9.0).alias("average_lead_time_days"))
    return policy.override(base, supplied).select("item_id", "store_id", "average_lead_time_days", "lost_sale_penalty")


def _lead_times(d: Data):
    return policy.recorded_lead_times(testdata.durations(d.spark, d.folder), d.settings)


def _with_recorded_lead_times(d: Data):
    """Assumptions in which recorded lead times replace the drawn ones; series without any keep theirs."""
    return policy.override(_assumed(d), _lead_times(d)).select(*_names("item_id store_id", _LEAD, "estimated_unit_cost"))


_LEAD = "average_lead_time_days lead_time_standard_deviation"
_KEY = "item_id store_id target_service_level"

QUERIES = [
    Query("v01_assumptions", lambda d: _assumed(d).select(*_names("item_id store_id supplier_id", _ASSUMED)),
          _sql("assumptions_now", "item_id store_id supplier_id", _ASSUMED), _ASSUMED),
    Query("v01_recorded_lead_times", lambda d: _lead_times(d).select(*_names("item_id store_id recorded_durations", _LEAD)),
          _sql("recorded_lead_times", "item_id store_id recorded_durations", _LEAD), _LEAD),
    Query("p17_recorded_assumptions", _with_recorded_lead_times,
          """SELECT a.item_id, a.store_id, coalesce(r.average_lead_time_days, a.average_lead_time_days) AS average_lead_time_days,
                    coalesce(r.lead_time_standard_deviation, a.lead_time_standard_deviation) AS lead_time_standard_deviation, a.estimated_unit_cost
             FROM assumptions_now AS a LEFT JOIN recorded_lead_times AS r ON r.item_id = a.item_id AND r.store_id = a.store_id""",
          f"{_LEAD} estimated_unit_cost"),
    Query("p17_overridden_assumptions", _overridden,
          """SELECT item_id, store_id, CASE WHEN store_id = 'S_1' THEN 9.0::DOUBLE ELSE average_lead_time_days END AS average_lead_time_days,
                    lost_sale_penalty FROM assumptions_now""", "average_lead_time_days lost_sale_penalty"),
    Query("q15_policy_input_violations", lambda d: policy.input_violations(_assumed(d)).agg(F.count(F.lit(1)).alias("failures")),
          """SELECT count(*) AS failures FROM assumptions_now WHERE estimated_unit_cost IS NULL OR estimated_unit_cost <= 0
             OR average_lead_time_days <= 0 OR initial_inventory IS NULL OR initial_inventory < 0 OR lost_sale_penalty IS NULL OR lost_sale_penalty < 0"""),
    Query("v06_policy", lambda d: d.policy.select(*_names(_KEY, "as_of_date", _POLICY)), _sql("policy_now", _KEY, "as_of_date", _POLICY), _POLICY),
    Query("v07_stockout_probability", lambda d: d.policy.select(*_names(_KEY, "stockout_probability")),
          _sql("policy_now", _KEY, "stockout_probability"), "stockout_probability"),
    Query("v08_sensitivity", lambda d: d.sensitivity.select(*_names(_WORLD, "sensitivity_factor multiplier", _KPIS, _COUNTS)),
          _sql("grid_ledger_kpis", _WORLD, "sensitivity_factor multiplier", _KPIS, _COUNTS), _KPIS),
    Query("v09_ledger", lambda d: d.ledger.select(*_names(_WORLD, "date stockout_event completed_cycles successful_cycles", _LEDGER)),
          _sql("ledger", _WORLD, "date stockout_event completed_cycles successful_cycles", _LEDGER), _LEDGER),
    Query("v10_ledger_kpis", lambda d: d.kpis.select(*_names(_WORLD, _KPIS, _COUNTS)), _sql("ledger_kpis", _WORLD, _KPIS, _COUNTS), _KPIS),
    Query("v11_excess_extract", lambda d: d.policy.filter("excess_units > 0").select(*_names(_KEY, "days_of_supply excess_units excess_value")),
          _sql("policy_now", _KEY, "days_of_supply excess_units excess_value", where="excess_units > 0"), "days_of_supply excess_units excess_value"),
    Query("d14_mart_stockout_risk", lambda d: marts.stockout_risk(d.policy).select(*_names(_KEY, "stockout_probability")),
          _sql("policy_now", _KEY, "stockout_probability", where="stockout_probability > 1 - target_service_level"), "stockout_probability"),
    Query("i16_highest_stockout_risk",
          lambda d: reports.highest_stockout_risk(d.policy.withColumn("stockout_probability", F.round("stockout_probability", 9)), 0.95).select(*_names(_KEY, _POLICY)),
          f"""SELECT {', '.join(_names(_KEY, _POLICY))} FROM (SELECT * REPLACE (round(stockout_probability, 9) AS stockout_probability) FROM policy_now)
              WHERE target_service_level = 0.95 ORDER BY stockout_probability DESC, item_id, store_id LIMIT 20""", _POLICY),
    Query("i17_excess_inventory", lambda d: reports.excess_inventory(d.policy, 0.95),
          "SELECT item_id, store_id, excess_units, excess_value FROM policy_now WHERE target_service_level = 0.95 AND excess_units > 0",
          "excess_units excess_value"),
    Query("i18_inventory_value_by_category", lambda d: reports.inventory_value_by_category(d.policy, 0.95, d.products),
          """SELECT d.category_id, sum(p.inventory_value) AS value FROM policy_now AS p JOIN dim_product AS d ON d.item_id = p.item_id
             WHERE p.target_service_level = 0.95 GROUP BY 1""", "value"),
    Query("i28_paired_cost_reduction", lambda d: reports.paired_cost_reduction(d.kpis, 0.95),
          """SELECT avg(saved) AS estimated_cost_reduction, stddev_samp(saved) AS between_run_std FROM (
               SELECT run_id, sum(total_inventory_cost) FILTER (policy = 'baseline') - sum(total_inventory_cost) FILTER (policy = 'optimized') AS saved
               FROM ledger_kpis WHERE target_service_level = 0.95 AND scenario = 'base' GROUP BY 1)""",
          "estimated_cost_reduction between_run_std"),
]
