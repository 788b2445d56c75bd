"""Schemas of the input files and of the canonical tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
}


def table(columns: str) -> T.StructType:
    """A schema from its DDL string, without the session that Spark's own parser needs."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CALENDAR = table(
    "date date, wm_yr_wk int, d string, snap_CA int, snap_TX int, snap_WI int, "
    "event_name_1 string, event_type_1 string, event_name_2 string, event_type_2 string"
)
PRICES = table("store_id string, item_id string, wm_yr_wk int, sell_price double")

SALES = table(
    "series_id string, item_id string, department_id string, category_id string, store_id string, state_id string, d string, date date, date_key int, "
    "units_sold long, sell_price double, revenue double, wm_yr_wk int, weekday int, month int, quarter int, year int, event_name string, "
    "event_type string, event_name_2 string, event_type_2 string, snap_flag int, event_flag int, weekend_flag int, "
    "month_start_flag int, month_end_flag int, zero_sales_flag int"
)
LINES = table(
    "order_item_id string, order_id long, order_date date, date_key int, shipping_mode string, market string, region string, category string, "
    "customer_segment string, product_name string, quantity double, sales double, profit double, invalid_sales_flag boolean, "
    "abnormal_profit_flag boolean, profit_margin double, loss_making_line boolean"
)
DELIVERY = table(
    "order_id long, order_date date, date_key int, shipping_mode string, market string, region string, customer_segment string, "
    "actual_shipping_days double, scheduled_shipping_days double, delivery_eligible boolean, late_order int, "
    "delay_days double, positive_delay_days double"
)
FORECAST = table(
    "item_id string, store_id string, origin date, date date, date_key int, horizon int, model string, forecast_units double, "
    "lower_80 double, upper_80 double, lower_95 double, upper_95 double"
)
BACKTEST = table(
    "item_id string, store_id string, state_id string, category_id string, department_id string, origin date, date date, date_key int, "
    "horizon int, model string, fold int, split_role string, forecast_units double, actual_units double, error double, absolute_error double, scale double"
)
POLICY = table(
    "item_id string, store_id string, as_of_date date, target_service_level double, initial_inventory double, "
    "forecast_daily_demand double, safety_stock double, reorder_point double, order_up_to_level double, eoq double, "
    "days_of_supply double, inventory_value double, stockout_probability double, recommended_order_quantity double, "
    "excess_units double, excess_value double"
)
LEDGER = table(
    "item_id string, store_id string, date date, policy string, scenario string, run_id int, target_service_level double, "
    "opening_inventory double, arrivals double, forecast_demand double, actual_demand double, fulfilled_units double, "
    "lost_sales_units double, order_quantity double, in_transit_units double, closing_inventory double, stockout_event int, "
    "holding_cost double, ordering_cost double, lost_sale_cost double, total_inventory_cost double, lost_sales_value double"
)

# Serving tables: target name -> schema. A load keeps only the columns named here.
SERVING = {
    "common.dim_date": table("date date, date_key int, year int, month int, quarter int"),
    "panel.dim_product": table("item_id string, department_id string, category_id string"),
    "panel.dim_store": table("store_id string, state_id string"),
    "panel.dim_state": table("state_id string"),
    "panel.dim_category": table("category_id string"),
    "panel.dim_department": table("department_id string, category_id string"),
    "panel.dim_event": table("event_name string, event_type string"),
    "panel.bridge_date_event": table("date_key int, event_name string"),
    "panel.fact_sell_price": table("item_id string, store_id string, wm_yr_wk int, sell_price double"),
    "orders.dim_order_date": table("date date, date_key int, year int, month int, quarter int"),
    "orders.dim_product_category": table("category string"),
    "orders.dim_market": table("market string"),
    "orders.dim_region": table("region string"),
    "orders.dim_shipping_mode": table("shipping_mode string"),
    "orders.dim_customer_segment": table("customer_segment string"),
    "orders.fact_profitability": LINES,
    "panel.fact_sales_daily": table(
        "item_id string, store_id string, date date, date_key int, units_sold long, sell_price double, revenue double, event_flag int, snap_flag int"
    ),
    "panel.fact_forecast": FORECAST,
    "panel.fact_forecast_accuracy": BACKTEST,
    "panel.fact_inventory_policy": POLICY,
    "panel.fact_inventory_replay": LEDGER,
    "orders.fact_orders": LINES,
    "orders.fact_delivery_performance": DELIVERY,
}

# Which table of a run fills which serving table.
SERVED = {target: target.split(".")[1] for target in SERVING} | {
    "panel.fact_sales_daily": "sales", "panel.fact_forecast": "forecast", "panel.fact_forecast_accuracy": "backtest",
    "panel.fact_inventory_policy": "policy", "panel.fact_inventory_replay": "ledger", "orders.fact_orders": "fact_lines",
    "orders.fact_profitability": "fact_lines", "orders.fact_delivery_performance": "fact_delivery",
}
