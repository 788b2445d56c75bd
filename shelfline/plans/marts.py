"""Serving marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import month_start, ratio
from shelfline.operators.panel import SERIES
from shelfline.operators.orders import valid


def sales_performance(sales: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Month, category, state and store; summed per month, item and store before the dimensions join."""
    monthly = sales.groupBy(month_start("date").alias("month"), *SERIES).agg(
        F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue")
    )
    return monthly.join(products.select("item_id", "category_id"), "item_id").join(stores, "store_id").groupBy(
        "month", "category_id", "state_id", "store_id"
    ).agg(F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue"))


def forecast_accuracy(backtest: DataFrame) -> DataFrame:
    return backtest.groupBy("model", "split_role", "store_id").agg(
        ratio(F.sum("absolute_error"), F.sum("actual_units")).alias("wape"),
        ratio(F.sum("error"), F.sum("actual_units")).alias("bias"),
    )


def product_store_performance(sales: DataFrame) -> DataFrame:
    return sales.groupBy(*SERIES).agg(
        F.sum("revenue").alias("revenue"), F.sum("units_sold").alias("units_sold"),
        F.avg("units_sold").alias("mean_units"),
        ratio(F.stddev_samp("units_sold"), F.avg("units_sold")).alias("demand_cv"),
    )


def stockout_risk(policy: DataFrame) -> DataFrame:
    return policy.filter(F.col("stockout_probability") > 1 - F.col("target_service_level"))


def shipping_mode_performance(delivery: DataFrame) -> DataFrame:
    """Late flags and delays are null for ineligible orders and drop out of the means."""
    return delivery.groupBy("shipping_mode").agg(
        F.count_if("delivery_eligible").alias("eligible_orders"),
        F.sum("late_order").alias("late_orders"),
        F.avg("late_order").alias("late_delivery_rate"),
        F.avg("positive_delay_days").alias("average_delay_days"),
    )


def profitability(lines: DataFrame) -> DataFrame:
    """Sales and profit of valid lines by category, market and region."""
    return valid(lines).groupBy("category", "market", "region").agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit"),
        ratio(F.sum("profit"), F.sum("sales")).alias("profit_margin"),
    )


def executive_kpis(sales: DataFrame, forecast: DataFrame, delivery: DataFrame, lines: DataFrame) -> DataFrame:
    """Four labelled rows; the two domains stay apart."""
    rows = [
        ("panel", "historical_revenue", sales.agg(F.sum("revenue").alias("value"))),
        ("panel", "forecast_units", forecast.agg(F.sum("forecast_units").alias("value"))),
        ("orders", "late_delivery_rate", delivery.filter("delivery_eligible").agg(F.avg("late_order").alias("value"))),
        ("orders", "profit", valid(lines).agg(F.sum("profit").alias("value"))),
    ]
    frames = [df.select(F.lit(d).alias("domain"), F.lit(m).alias("metric"), F.col("value").cast("double")) for d, m, df in rows]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
