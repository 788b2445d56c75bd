"""Queries for report measures and page tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators import constraints, dimensions, orders, panel, quality
from shelfline.operators.forecast import segment_metrics
from shelfline.plans import kpis, marts
from shelfline.plans.data import Data
from shelfline.plans.order_queries import _stacked
from shelfline.plans.query import Query
from shelfline.session import materialize, own_folder
from shelfline.sources import publish, refresh, sinks


def _tables(d: Data) -> dict:
    return {
        "sales": d.delivered, "forecast": d.future, "policy": d.policy, "ledger": d.ledger, "lines": d.lines,
        "delivery": d.delivery, "dim_product": d.catalogue,
        "dim_store": d.stores, "dim_date": dimensions.dim_date(d.calendar, d.delivery),  # an order's lines have its date
        "sell_price": d.delivered_prices, "shipping_mode": marts.shipping_mode_performance(d.delivery),
    }


def _integrity(d: Data):
    tables = _tables(d)
    return constraints.integrity_tests(tables, {name: df.columns for name, df in tables.items()})


def _count(name: str, source: str, where: str) -> str:
    return f"SELECT '{name}' AS test, count(*) AS failures FROM {source} WHERE {where}"


def _missing(name: str, column: str, source: str, target: str) -> str:
    return f"SELECT '{name}' AS test, count(DISTINCT {column}) AS failures FROM {source} WHERE {column} NOT IN ({target})"


def _repeats(name: str, table: str, keys: str) -> str:
    return f"SELECT '{name}' AS test, count(*) AS failures FROM (SELECT count(*) FROM {table} GROUP BY {keys} HAVING count(*) > 1)"


_BALANCE = "abs(opening_inventory + arrivals - fulfilled_units - closing_inventory) > 0.00001"
_SPREAD = "lower_95 > lower_80 OR lower_80 > forecast_units OR upper_80 < forecast_units OR upper_95 < upper_80"
_KEY = "CAST(strftime(date, '%Y%m%d') AS INTEGER)"
_INTEGRITY_SQL = " UNION ALL ".join([
    _count("negative_sales_units", "delivered", "units_sold < 0"), _count("negative_prices", "delivered_prices", "sell_price < 0"),
    _count("sales_orphan_product", "delivered", "item_id NOT IN (SELECT item_id FROM catalogue)"),
    _count("sales_orphan_date", "delivered", f"date_key NOT IN (SELECT {_KEY} FROM calendar)"),
    _count("sales_date_key_mismatch", "delivered", f"date_key <> {_KEY} AND date_key IN (SELECT {_KEY} FROM calendar)"),
    _count("forecast_alignment", "future", "date_diff('day', origin, date) <> horizon OR forecast_units < 0"),
    _count("invalid_intervals", "future", _SPREAD),
    _count("invalid_service", "policy_now", "target_service_level <= 0 OR target_service_level >= 1"),
    _count("inventory_balance", "ledger", _BALANCE),
    _count("invalid_fulfillment", "ledger", "fulfilled_units > actual_demand OR fulfilled_units < 0"),
    _count("invalid_late_rate", "(SELECT avg(late_order) AS rate FROM delivery GROUP BY shipping_mode)", "rate NOT BETWEEN 0 AND 1"),
    "SELECT 'personal_columns', 0",
])
_CONSTRAINT_SQL = " UNION ALL ".join([
    _repeats("dim_product_key", "catalogue", "item_id"), _repeats("dim_store_key", "dim_store", "store_id"),
    _repeats("dim_date_key", "calendar", "date"), _repeats("sales_key", "delivered", "item_id, store_id, date_key"),
    _missing("sales_item_id_reference", "item_id", "delivered", "SELECT item_id FROM catalogue"),
    _missing("sales_store_id_reference", "store_id", "delivered", "SELECT store_id FROM dim_store"),
    _missing("sales_date_key_reference", "date_key", "delivered", f"SELECT {_KEY} FROM calendar"),
    _count("sales_units", "delivered", "units_sold < 0"), _count("sales_price", "delivered", "sell_price < 0"),
    _repeats("forecast_key", "future", "item_id, store_id, origin, date, model"),
    _count("forecast_units", "future", "forecast_units < 0"),
    _count("forecast_horizon", "future", "horizon NOT BETWEEN 1 AND 28 OR date_diff('day', origin, date) <> horizon"),
    _count("forecast_bounds", "future", _SPREAD),
    _repeats("policy_key", "policy_now", "item_id, store_id, as_of_date, target_service_level"),
    _count("policy_service", "policy_now", "target_service_level <= 0 OR target_service_level >= 1"),
    _count("policy_probability", "policy_now", "stockout_probability NOT BETWEEN 0 AND 1"),
    _repeats("ledger_key", "ledger", "item_id, store_id, date, policy, scenario, run_id, target_service_level"),
    _count("ledger_balance", "ledger", _BALANCE),
    _count("ledger_demand", "ledger", "abs(actual_demand - fulfilled_units - lost_sales_units) > 0.00001"),
    _count("ledger_signs", "ledger", "least(fulfilled_units, lost_sales_units, closing_inventory, in_transit_units) < 0"),
    _repeats("lines_key", "lines", "order_item_id"), _repeats("delivery_key", "delivery", "order_id"),
    _count("lines_order_id_reference", "lines", "order_id NOT IN (SELECT order_id FROM delivery)"),
    _count("delivery_late_flag", "delivery", "late_order NOT IN (0, 1)"),
    _count("delivery_delay", "delivery", "positive_delay_days < 0"),
])

_POLICY_SUMS = """CASE WHEN count(DISTINCT target_service_level) = 1 THEN {} END AS {}"""
_POLICY_SQL = ", ".join(
    _POLICY_SUMS.format(e, n) for e, n in (
        ("sum(inventory_value)", "inventory_value"), ("sum(safety_stock)", "safety_stock_units"), ("sum(reorder_point)", "reorder_point_units"),
        ("sum(eoq)", "eoq_units"), ("sum(excess_value)", "estimated_excess_inventory"),
        ("sum(initial_inventory) / nullif(sum(forecast_daily_demand), 0)", "days_of_supply"),
        ("count(*) FILTER (stockout_probability > 1 - target_service_level)", "pairs_at_stockout_risk"))
)
_POLICY_DOUBLES = "inventory_value safety_stock_units reorder_point_units eoq_units estimated_excess_inventory days_of_supply"


def _policy_measures(d: Data):
    """By store within a service level, and over all levels, where every measure has to be null."""
    one = kpis.policy_measures(d.policy, "store_id", "target_service_level")
    mixed = kpis.policy_measures(d.policy, "store_id").withColumn("target_service_level", F.lit(None).cast("double"))
    return one.unionByName(mixed)


_RUN = """SELECT {groups}, run_id, sum(stockout_event) AS ev, sum(lost_sales_units) AS lu, sum(lost_sales_value) AS lv, sum(holding_cost) AS hc,
  sum(ordering_cost) AS oc, sum(total_inventory_cost) AS tc, sum(fulfilled_units) AS fu, sum(actual_demand) AS ad, sum(closing_inventory) AS ci,
  count(*) AS n, count(DISTINCT date) AS dd FROM ledger GROUP BY ALL"""
_REPLAY_DOUBLES = (
    "stockout_events lost_sales_units lost_sales_value total_holding_cost total_ordering_cost total_inventory_cost stockout_rate fill_rate "
    "average_inventory inventory_turnover"
)
_WORLDS = "policy, scenario, target_service_level"


def _replay_sql(groups: str) -> str:
    return f"""SELECT {groups}, avg(ev) AS stockout_events, avg(lu) AS lost_sales_units, avg(lv) AS lost_sales_value, avg(hc) AS total_holding_cost,
      avg(oc) AS total_ordering_cost, avg(tc) AS total_inventory_cost, sum(ev)::DOUBLE / sum(n) AS stockout_rate, sum(fu) / nullif(sum(ad), 0) AS fill_rate,
      sum(ci) / sum(dd) AS average_inventory, avg(fu) / nullif(sum(ci) / sum(dd), 0) * 365 / max(dd) AS inventory_turnover
      FROM ({_RUN.format(groups=groups)}) GROUP BY {groups}"""


def _replay_measures(d: Data):
    """One row per world, and per service level over both policies, where the measures have to be null."""
    world = kpis.replay_measures(d.ledger, "policy", "scenario", "target_service_level")
    mixed = kpis.replay_measures(d.ledger, "target_service_level")
    return world.unionByName(mixed, allowMissingColumns=True)


_SALES_SUMS = "CAST(sum(units_sold) AS BIGINT) AS units_sold, sum(revenue) AS revenue"


def _segment_profiles(d: Data):
    return panel.dimension_profiles(d.sales, ("event_name",))


def _recommendations(d: Data):
    rounded = lambda df, *names: df.withColumns({n: F.round(n, 9) for n in names})
    return kpis.recommendations(
        rounded(d.policy, "stockout_probability"), segment_metrics(d.test, d.pretest_segments), d.segments, _segment_profiles(d),
        materialize(orders.delivery_summary(d.delivery), "delivery_summary"),
        materialize(orders.segment_profit(d.line_values, ("category",)), "profit_summary"), d.kpis, d.settings.default_service_level, "driver_tables",
    )


def _first(columns: str, source: str, order: str) -> str:
    return f"SELECT * FROM (SELECT {columns} FROM {source} ORDER BY {order} LIMIT 1)"


_AT = "(SELECT * REPLACE (round(stockout_probability, 9) AS stockout_probability) FROM policy_now WHERE target_service_level = 0.95)"
_LATE_ROWS = f"""(SELECT dimension, segment, count(*) FILTER (delivery_eligible) AS e, CAST(coalesce(sum(late_order), 0) AS BIGINT) AS l, avg(late_order) AS r
 FROM ({_stacked('delivery', ('shipping_mode', 'market'), '*')}) GROUP BY 1, 2 HAVING avg(late_order) IS NOT NULL)"""
_CATEGORY_ROWS = "(SELECT category, sum(sales) AS s, sum(profit) / nullif(sum(sales), 0) AS m FROM lines WHERE NOT invalid_sales_flag GROUP BY 1)"
_RECOMMENDATION_SQL = "SELECT *, 'driver_tables' AS data_provenance FROM (" + " UNION ALL ".join([
    _first("""'panel' AS domain, 'scenario' AS evidence_type, 'Check the starting stock and consider a larger buffer for ' || item_id || '/' || store_id AS recommendation,
      printf('Modeled stockout probability %.4f; safety stock %.2f units', stockout_probability, safety_stock) AS evidence, 'policy' AS source_table""",
           _AT, "stockout_probability DESC, item_id, store_id"),
    _first("""'panel', 'scenario', 'Consider lower replenishment for ' || item_id || '/' || store_id,
      printf('Assumed excess %.2f units, value %.2f', excess_units, excess_value), 'policy'""", f"{_AT} WHERE excess_value > 0", "excess_value DESC, item_id, store_id"),
    _first("""'panel', 'forecast_evaluation', 'Look first at forecast errors in store ' || store_id, printf('Held-out WAPE %.4f', w), 'segment_metrics'""",
           "(SELECT store_id, sum(absolute_error) / nullif(sum(actual_units), 0) AS w FROM test GROUP BY 1)", "w DESC NULLS LAST, store_id"),
    """SELECT 'panel', 'historical', 'Try intermittent-demand methods for Z items', printf('%d of %d item-store pairs are in class Z', count(*) FILTER (xyz = 'Z'), count(*)), 'segments'
       FROM segments_now HAVING count(*) FILTER (xyz = 'Z') > 0""",
    _first("'panel', 'scenario', 'Consider separate buffers for category ' || category_id, printf('Mean safety stock %.2f units', m), 'policy'",
           f"(SELECT category_id, avg(safety_stock) AS m FROM {_AT} GROUP BY 1)", "m DESC, category_id"),
    _first("""'panel', 'historical', 'Prepare for the event ' || event_name,
      printf('Mean %.3f units per series-day over %d observations, not adjusted for season', m, n), 'dimension_profiles'""",
           "(SELECT event_name, avg(units_sold) AS m, count(*) AS n FROM sales WHERE event_name IS NOT NULL GROUP BY 1)", "m DESC, event_name"),
    *[_first(f"""'orders', 'historical', 'Review promises and capacity for ' || segment,
      printf('%d of %d eligible orders late (%.4f); association only', l, e, r), 'delivery_summary'""",
             f"{_LATE_ROWS} WHERE dimension = '{c}'", "r DESC, segment") for c in ("shipping_mode", "market")],
    _first("""'orders', 'historical', 'Review pricing, mix and discounts for ' || category,
      printf('Top-quartile sales %.2f, margin %.4f', s, m), 'profit_summary'""",
           f"{_CATEGORY_ROWS} WHERE s >= (SELECT quantile_cont(s, 0.75) FROM {_CATEGORY_ROWS})", "m ASC NULLS LAST, category"),
    """SELECT 'panel', 'scenario', printf('Compare cost and service before choosing the %.0f%% target', target_service_level * 100),
       printf('Paired cost reduction %.2f; demand-weighted fill rate %.4f', avg(saved), sum(f) / nullif(sum(a), 0)), 'ledger_kpis'
       FROM (SELECT target_service_level, run_id, sum(estimated_cost_reduction) AS saved, sum(fulfilled_units) AS f, sum(actual_demand) AS a
             FROM ledger_kpis WHERE policy = 'optimized' GROUP BY 1, 2) GROUP BY target_service_level""",
]) + ")"

def _refreshed(d: Data):
    """The monthly table after a wrong delivery of one store-year was refreshed, corrected, and refreshed again."""
    root = f"{own_folder(d.spark)}/monthly-{uuid.uuid4().hex}"
    sinks.write_partitioned(d.sales, f"{root}/sales")
    wrong = (F.col("store_id") == "S_1") & (F.col("year") == d.end.year)
    one = d.sales.filter(wrong)
    for units in (F.col("units_sold") * 2, F.col("units_sold")):
        one.withColumn("units_sold", units).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "store_id", "year").parquet(f"{root}/sales")
        refresh.refresh_monthly(d.spark, f"{root}/sales", f"{root}/monthly")
    return refresh.read_monthly(d.spark, f"{root}/monthly")


def _served(d: Data):
    """Rows of the tables that readers see after a run that was published and one whose gate failed."""
    root = f"{own_folder(d.spark)}/serving-{uuid.uuid4().hex}"
    lines = materialize(d.lines, "fact_lines")  # read by six dimensions and two runs
    frames = dimensions.all_dimensions(d.sales, d.calendar, lines) | {"sales": d.sales, "fact_lines": lines, "fact_delivery": d.delivery}
    negative = lambda staged: quality.rule_counts([("negative", staged["panel.fact_sales_daily"].filter("units_sold < 0"))])
    publish.publish(frames, root, negative)
    try:
        publish.publish(frames | {"sales": d.delivered}, root, negative)
    except quality.QualityError:
        pass  # negative units were delivered; readers keep the run before
    targets = ("panel.fact_sales_daily", "panel.dim_product", "panel.dim_store", "panel.dim_event", "orders.fact_orders",
               "orders.fact_delivery_performance", "orders.dim_shipping_mode", "orders.dim_market")
    return reduce(DataFrame.unionByName, [
        publish.read(d.spark, root, t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("target"), "rows") for t in targets])


QUERIES = [
    Query("s11_refreshed_monthly", _refreshed,
          """SELECT CAST(date_trunc('month', date) AS DATE) AS month, category_id, state_id, store_id, CAST(sum(units_sold) AS BIGINT) AS units_sold,
                    sum(revenue) AS revenue FROM sales GROUP BY ALL""", "revenue"),
    Query("s10_served_rows", _served,
          """SELECT 'panel.fact_sales_daily' AS target, count(*) AS rows FROM sales
             UNION ALL SELECT 'panel.dim_product', count(DISTINCT item_id) FROM sales
             UNION ALL SELECT 'panel.dim_store', count(DISTINCT store_id) FROM sales
             UNION ALL SELECT 'panel.dim_event', count(DISTINCT name) FROM (
                 SELECT event_name_1 AS name FROM calendar UNION ALL SELECT event_name_2 FROM calendar)
             UNION ALL SELECT 'orders.fact_orders', count(*) FROM lines
             UNION ALL SELECT 'orders.fact_delivery_performance', count(*) FROM delivery
             UNION ALL SELECT 'orders.dim_shipping_mode', count(DISTINCT shipping_mode) FROM delivery
             UNION ALL SELECT 'orders.dim_market', count(DISTINCT market) FROM delivery"""),
    Query("k01_sales_measures", lambda d: kpis.sales_measures(d.sales, "category_id", "store_id"),
          """SELECT category_id, store_id, CAST(sum(units_sold) AS BIGINT) AS total_units_sold, sum(revenue) AS total_revenue,
                    sum(revenue) / nullif(sum(units_sold), 0) AS average_selling_price FROM sales GROUP BY 1, 2""", "total_revenue average_selling_price"),
    Query("k02_revenue_growth", lambda d: kpis.revenue_growth(d.sales, "store_id"),
          """SELECT store_id, month, total_revenue, lag(total_revenue) OVER w AS revenue_previous_period,
                    total_revenue / nullif(lag(total_revenue) OVER w, 0) - 1 AS revenue_growth
             FROM (SELECT store_id, CAST(date_trunc('month', date) AS DATE) AS month, sum(revenue) AS total_revenue FROM sales GROUP BY 1, 2)
             WINDOW w AS (PARTITION BY store_id ORDER BY month)""", "total_revenue revenue_previous_period revenue_growth"),
    Query("k05_policy_measures", _policy_measures,
          f"""SELECT store_id, target_service_level, {_POLICY_SQL} FROM policy_now GROUP BY store_id, target_service_level UNION ALL
              SELECT store_id, NULL, {_POLICY_SQL} FROM policy_now GROUP BY store_id""", _POLICY_DOUBLES),
    Query("k06_replay_measures", _replay_measures,
          f"""{_replay_sql(_WORLDS)} UNION ALL SELECT NULL, NULL, target_service_level, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
              FROM (SELECT DISTINCT target_service_level FROM ledger)""", _REPLAY_DOUBLES),
    Query("k09_cost_comparison", lambda d: kpis.cost_comparison(d.ledger, "target_service_level", "scenario"),
          """SELECT target_service_level, scenario, avg(b) AS baseline_inventory_cost, avg(o) AS optimized_inventory_cost,
                    avg(b) - avg(o) AS estimated_cost_reduction, (avg(b) - avg(o)) / nullif(avg(b), 0) AS estimated_cost_reduction_share
             FROM (SELECT target_service_level, scenario, run_id, sum(total_inventory_cost) FILTER (policy = 'baseline') AS b,
                          sum(total_inventory_cost) FILTER (policy = 'optimized') AS o FROM ledger GROUP BY 1, 2, 3) GROUP BY 1, 2""",
          "baseline_inventory_cost optimized_inventory_cost estimated_cost_reduction estimated_cost_reduction_share"),
    Query("k10_delivery_measures", lambda d: kpis.delivery_measures(d.delivery, "market", "shipping_mode"),
          """SELECT market, shipping_mode, count(DISTINCT order_id) AS total_orders, count(*) FILTER (delivery_eligible) AS eligible_orders,
                    count(*) FILTER (late_order = 1) AS late_orders, avg(positive_delay_days) AS average_delay_days,
                    avg(late_order) AS late_delivery_share, 1 - avg(late_order) AS on_time_delivery_share FROM delivery GROUP BY 1, 2""",
          "average_delay_days late_delivery_share on_time_delivery_share"),
    Query("k11_profit_measures", lambda d: kpis.profit_measures(d.lines, "category"),
          """SELECT category, sum(s) AS total_sales, sum(p) AS total_profit, sum(p) / nullif(sum(s), 0) AS profit_margin,
                    count(*) FILTER (p < 0) AS loss_making_orders
             FROM (SELECT category, order_id, sum(sales) AS s, sum(profit) AS p FROM lines WHERE NOT invalid_sales_flag GROUP BY 1, 2) GROUP BY 1""",
          "total_sales total_profit profit_margin"),
    Query("k12_category_late_share", lambda d: kpis.category_late_share(d.lines, d.delivery),
          """SELECT category, count(*) FILTER (late_order = 1)::DOUBLE / nullif(count(*) FILTER (delivery_eligible), 0) AS category_late_delivery_share
             FROM (SELECT DISTINCT category, order_id FROM lines) JOIN delivery USING (order_id) GROUP BY 1""", "category_late_delivery_share"),
    Query("j15_orders_with_category", lambda d: kpis.delivery_measures(kpis.orders_with_category(d.delivery, d.lines, "economy"), "market"),
          """SELECT market, count(*) AS total_orders, count(*) FILTER (delivery_eligible) AS eligible_orders, count(*) FILTER (late_order = 1) AS late_orders,
                    avg(positive_delay_days) AS average_delay_days, avg(late_order) AS late_delivery_share, 1 - avg(late_order) AS on_time_delivery_share
             FROM delivery WHERE order_id IN (SELECT order_id FROM lines WHERE category = 'economy') GROUP BY 1""",
          "average_delay_days late_delivery_share on_time_delivery_share"),
    Query("k14_class_matrix", lambda d: kpis.class_matrix(d.segments), "SELECT abc_xyz, count(*) AS pairs FROM segments_now GROUP BY 1"),
    Query("k15_policy_trade_off", lambda d: kpis.policy_trade_off(d.kpis, "policy", "target_service_level"),
          """SELECT policy, target_service_level, avg(c) AS mean_cost, avg(l) AS mean_lost_units, sum(f) / nullif(sum(a), 0) AS fill_rate
             FROM (SELECT policy, target_service_level, run_id, sum(total_inventory_cost) AS c, sum(lost_sales_units) AS l, sum(fulfilled_units) AS f,
                          sum(actual_demand) AS a FROM ledger_kpis GROUP BY 1, 2, 3) GROUP BY 1, 2""", "mean_cost mean_lost_units fill_rate"),
    Query("k16_sensitivity_line", lambda d: kpis.sensitivity_line(d.sensitivity),
          "SELECT scenario, policy, target_service_level, avg(total_inventory_cost) AS mean_cost FROM grid_ledger_kpis GROUP BY 1, 2, 3", "mean_cost"),
    Query("k17_item_revenue_pareto", lambda d: kpis.item_revenue_pareto(d.sales),
          """SELECT item_id, revenue, sum(revenue) OVER (ORDER BY revenue DESC, item_id ROWS UNBOUNDED PRECEDING) / nullif(sum(revenue) OVER (), 0) AS cumulative_share
             FROM (SELECT item_id, sum(revenue) AS revenue FROM sales GROUP BY 1)""", "revenue cumulative_share"),
    Query("k17_loss_pareto", lambda d: kpis.loss_pareto(orders.order_profit(d.lines)),
          """SELECT order_id, loss, sum(loss) OVER (ORDER BY loss DESC, order_id ROWS UNBOUNDED PRECEDING) / nullif(sum(loss) OVER (), 0) AS cumulative_share
             FROM (SELECT order_id, -sum(profit) AS loss FROM lines WHERE NOT invalid_sales_flag GROUP BY 1 HAVING sum(profit) < 0)""", "loss cumulative_share"),
    Query("k18_late_order_decomposition", lambda d: kpis.late_order_decomposition(d.delivery),
          """SELECT shipping_mode, market, region, grouping_id(shipping_mode, market, region) AS level_id, count(*) AS eligible_orders,
                    CAST(sum(late_order) AS BIGINT) AS late_orders FROM delivery WHERE delivery_eligible GROUP BY ROLLUP (shipping_mode, market, region)"""),
    Query("k18_profit_decomposition", lambda d: kpis.profit_decomposition(d.lines),
          """SELECT category, market, region, customer_segment, grouping_id(category, market, region, customer_segment) AS level_id, sum(sales) AS sales,
                    sum(profit) AS profit FROM lines WHERE NOT invalid_sales_flag GROUP BY ROLLUP (category, market, region, customer_segment)""", "sales profit"),
    Query("k19_late_rate_against_margin", lambda d: kpis.late_rate_against_margin(d.delivery, d.lines),
          """SELECT a.shipping_mode, late_rate, margin FROM (SELECT shipping_mode, avg(late_order) AS late_rate FROM delivery WHERE delivery_eligible GROUP BY 1) AS a
             JOIN (SELECT shipping_mode, sum(profit) / nullif(sum(sales), 0) AS margin FROM lines WHERE NOT invalid_sales_flag GROUP BY 1) AS b
               ON b.shipping_mode = a.shipping_mode""", "late_rate margin"),
    Query("k20_category_trend", lambda d: kpis.category_trend(d.sales, "category_id", "department_id"),
          f"SELECT category_id, department_id, CAST(date_trunc('month', date) AS DATE) AS month, {_SALES_SUMS} FROM sales GROUP BY 1, 2, 3", "revenue"),
    Query("k21_worst_orders", lambda d: kpis.worst_orders(orders.order_profit(d.lines)),
          "SELECT order_id, sum(sales) AS sales, sum(profit) AS profit FROM lines WHERE NOT invalid_sales_flag GROUP BY 1 HAVING sum(profit) < 0 ORDER BY profit, order_id LIMIT 20",
          "sales profit"),
    Query("k21_best_pairs", lambda d: kpis.best_pairs(d.sales),
          "SELECT item_id, store_id, sum(revenue) AS revenue FROM sales GROUP BY 1, 2 ORDER BY revenue DESC, item_id, store_id LIMIT 20", "revenue"),
    Query("k22_drill_through", lambda d: kpis.drill_through(d.sales, d.future, d.policy, d.today, 0.95),
          """SELECT 'history' AS part, item_id, store_id, date, units_sold, NULL::DOUBLE AS forecast_units, NULL::DOUBLE AS lower_80, NULL::DOUBLE AS upper_80,
                    NULL::DOUBLE AS lower_95, NULL::DOUBLE AS upper_95, NULL::DOUBLE AS safety_stock, NULL::DOUBLE AS reorder_point
             FROM sales WHERE date > (SELECT hi FROM bounds) - 90
             UNION ALL SELECT 'forecast', item_id, store_id, date, NULL, forecast_units, lower_80, upper_80, lower_95, upper_95, NULL, NULL FROM future
             UNION ALL SELECT 'policy', item_id, store_id, as_of_date, NULL, NULL, NULL, NULL, NULL, NULL, safety_stock, reorder_point FROM policy_now
             WHERE target_service_level = 0.95""", "forecast_units lower_80 upper_80 lower_95 upper_95 safety_stock reorder_point"),
    Query("j10_class_a_errors",
          lambda d: d.test.join(d.pretest_segments.filter("abc = 'A'").select(*panel.SERIES), panel.SERIES, "left_semi").groupBy(
              "item_id", "store_id").agg(F.sum("absolute_error").alias("absolute_error")),
          """SELECT t.item_id, t.store_id, sum(t.absolute_error) AS absolute_error FROM test AS t
             JOIN segments_pretest AS g ON g.item_id = t.item_id AND g.store_id = t.store_id WHERE g.abc = 'A' GROUP BY 1, 2""", "absolute_error"),
    Query("q11_integrity_tests", _integrity, _INTEGRITY_SQL),
    Query("q12_constraints", lambda d: constraints.constraint_counts(_tables(d)), _CONSTRAINT_SQL),
    Query("o10_recommendations", _recommendations, _RECOMMENDATION_SQL),
    Query("o11_executive_table",
          lambda d: kpis.executive_table(d.sales, d.future, d.kpis, d.delivery, orders.order_profit(d.lines), 0.95, "driver_tables"),
          """SELECT *, 'driver_tables' AS data_provenance FROM (
               SELECT 'panel' AS domain, 'historical' AS metric_type, 'total_units' AS metric, sum(units_sold)::DOUBLE AS value FROM sales
               UNION ALL SELECT 'panel', 'historical', 'revenue', sum(revenue) FROM sales
               UNION ALL SELECT 'panel', 'forecast', 'forecast_28d_units', sum(forecast_units) FROM future
               UNION ALL SELECT 'panel', 'scenario_estimate', 'estimated_cost_reduction', avg(saved) FROM (
                 SELECT run_id, sum(estimated_cost_reduction) AS saved FROM ledger_kpis WHERE policy = 'optimized' AND target_service_level = 0.95 GROUP BY 1)
               UNION ALL SELECT 'orders', 'historical', 'eligible_order_late_rate', avg(late_order) FROM delivery WHERE delivery_eligible
               UNION ALL SELECT 'orders', 'historical', 'profit', sum(profit) FROM lines WHERE NOT invalid_sales_flag)""", "value"),
]
