"""Analytical queries over the facts and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.columns import month_start, ratio
from shelfline.operators import segments
from shelfline.operators.features import by_date
from shelfline.operators.ordered import dense_ranked, exact_quantiles
from shelfline.operators.orders import valid
from shelfline.operators.panel import SERIES, trailing
from shelfline.settings import DEFAULTS, Settings


def monthly_growth(sales: DataFrame) -> DataFrame:
    """The window sees one row per calendar month."""
    previous = F.lag("revenue").over(Window.orderBy("month"))
    monthly = sales.groupBy(month_start("date").alias("month")).agg(F.sum("revenue").alias("revenue"))
    return monthly.withColumn("mom_growth", ratio("revenue", previous) - 1)


def store_ranking(sales: DataFrame) -> DataFrame:
    return dense_ranked(sales.groupBy("store_id").agg(F.sum("revenue").alias("revenue")), "revenue", "rank")


def category_contribution(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue is summed per item before items meet their category."""
    by_item = sales.groupBy("item_id").agg(F.sum("revenue").alias("revenue"))
    by_category = by_item.join(products, "item_id").groupBy("category_id").agg(F.sum("revenue").alias("revenue"))
    return by_category.withColumn("contribution", ratio("revenue", by_item.agg(F.sum("revenue")).scalar()))


def top_items(sales: DataFrame, origin: Column, n: int = 20, days: int = 90) -> DataFrame:
    recent = trailing(sales, origin, days).groupBy("item_id").agg(F.sum("revenue").alias("revenue"))
    return recent.orderBy(F.desc("revenue"), "item_id").limit(n)


def bottom_items(sales: DataFrame, n: int = 20) -> DataFrame:
    by_item = sales.groupBy("item_id").agg(F.sum("revenue").alias("revenue"))
    return by_item.orderBy(F.asc_nulls_last("revenue"), "item_id").limit(n)


def demand_variability(sales: DataFrame) -> DataFrame:
    return segments.variability(sales).select(*SERIES, "cv", "zero_share")


def abc_by_item(sales: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    by_item = sales.groupBy("item_id").agg(F.sum("revenue").alias("revenue"))
    return segments.revenue_shares(by_item, ["item_id"]).select(
        "item_id", "revenue", "prior_share", segments.abc_class(F.col("prior_share"), settings).alias("abc")
    )


def xyz_by_series(sales: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return segments.variability(sales).select(
        *SERIES, segments.xyz_class(F.col("zero_share"), F.col("cv"), settings).alias("xyz")
    )


def abc_xyz_by_series(sales: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    shared = segments.revenue_shares(segments.variability(sales), SERIES)
    label = F.concat_ws(
        "-", segments.abc_class(F.col("prior_share"), settings),
        segments.xyz_class(F.col("zero_share"), F.col("cv"), settings),
    )
    return shared.select(*SERIES, "revenue", "cv", "zero_share", "prior_share", label.alias("abc_xyz"))


def price_and_demand_changes(sales: DataFrame) -> DataFrame:
    w = by_date()
    return sales.select(
        *SERIES, "date",
        (ratio("sell_price", F.lag("sell_price").over(w)) - 1).alias("price_change"),
        (F.col("units_sold") - F.lag("units_sold").over(w)).alias("demand_change"),
        F.lead("units_sold").over(w).alias("next_day_units"),
    )


def event_uplift(sales: DataFrame) -> DataFrame:
    mean = lambda f: F.avg(F.when(F.col("event_flag") == f, F.col("units_sold")))
    return sales.groupBy("item_id").agg((ratio(mean(1), mean(0)) - 1).alias("unadjusted_event_uplift"))


def wape_by(test: DataFrame, *keys: str) -> DataFrame:
    return test.groupBy(*keys).agg(ratio(F.sum("absolute_error"), F.sum("actual_units")).alias("wape"))


def wape_by_category(test: DataFrame, products: DataFrame) -> DataFrame:
    """Errors are summed per item before items meet their category."""
    by_item = test.groupBy("item_id", "model").agg(
        F.sum("absolute_error").alias("absolute_error"), F.sum("actual_units").alias("actual_units")
    )
    return wape_by(by_item.join(products.select("item_id", "category_id"), "item_id"), "category_id", "model")


def at_service(policy: DataFrame, level: float) -> DataFrame:
    return policy.filter(F.col("target_service_level") == level)


def highest_stockout_risk(policy: DataFrame, level: float, n: int = 20) -> DataFrame:
    return at_service(policy, level).orderBy(F.desc("stockout_probability"), *SERIES).limit(n)


def excess_inventory(policy: DataFrame, level: float) -> DataFrame:
    return at_service(policy, level).filter("excess_units > 0").select(*SERIES, "excess_units", "excess_value")


def inventory_value_by_category(policy: DataFrame, level: float, products: DataFrame) -> DataFrame:
    by_item = at_service(policy, level).groupBy("item_id").agg(F.sum("inventory_value").alias("value"))
    return by_item.join(products.select("item_id", "category_id"), "item_id").groupBy("category_id").agg(F.sum("value").alias("value"))


def eligible(delivery: DataFrame) -> DataFrame:
    return delivery.filter("delivery_eligible")


def late_rate_by_mode(delivery: DataFrame) -> DataFrame:
    return eligible(delivery).groupBy("shipping_mode").agg(
        F.count(F.lit(1)).alias("eligible_orders"), F.avg("late_order").alias("late_rate")
    )


def delay_by_region(delivery: DataFrame) -> DataFrame:
    """Mean and 90th percentile. A delay is a whole number of days within the accepted durations, so
    the percentile's buffer holds a bounded number of distinct values however large the region."""
    return eligible(delivery).groupBy("region").agg(
        F.avg("positive_delay_days").alias("average_delay"),
        F.percentile("positive_delay_days", F.lit(0.9)).alias("p90_delay"),
    )


def margin_by_category(lines: DataFrame) -> DataFrame:
    return valid(lines).groupBy("category").agg(ratio(F.sum("profit"), F.sum("sales")).alias("margin"))


def loss_making_orders(lines: DataFrame) -> DataFrame:
    return valid(lines).groupBy("order_id").agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit")
    ).filter("profit < 0")


def big_sellers_with_low_margin(lines: DataFrame, share: float = 0.75, margin: float = 0.05) -> DataFrame:
    products = valid(lines).groupBy("product_name").agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    threshold = exact_quantiles(products, [], "sales", {"threshold": share}).select("threshold").scalar()
    return products.withColumn("margin", ratio("profit", "sales")).filter(
        (F.col("sales") >= threshold) & (F.col("margin") < margin)
    )


def late_order_pareto(delivery: DataFrame) -> DataFrame:
    late = eligible(delivery).groupBy("region").agg(F.sum("late_order").alias("late_orders"))
    return segments.revenue_shares(late, ["region"], "late_orders").drop("prior_share")


def planning_calendar(sales: DataFrame, days: int = 28) -> DataFrame:
    """The days after the last day of history."""
    last = sales.agg(F.max("date").alias("last"))
    return last.select(F.explode(F.sequence(F.lit(1), F.lit(days))).alias("horizon"), "last").select(
        F.date_add("last", F.col("horizon")).alias("date"), "horizon"
    )


def store_revenue_between(sales: DataFrame, first_key: int, last_key: int) -> DataFrame:
    """Revenue by store over a range of date keys; the year bounds skip the other partitions."""
    return sales.filter(
        F.col("date_key").between(first_key, last_key) & F.col("year").between(first_key // 10000, last_key // 10000)
    ).groupBy("store_id").agg(F.sum("revenue").alias("revenue"))


def paired_cost_reduction(kpis: DataFrame, level: float, scenario: str = "base") -> DataFrame:
    """Portfolio cost per run first; then the mean and the spread of the paired difference over runs."""
    chosen = kpis.filter((F.col("target_service_level") == level) & (F.col("scenario") == scenario))
    runs = chosen.groupBy("run_id").pivot("policy", ["baseline", "optimized"]).agg(F.sum("total_inventory_cost"))
    saved = F.col("baseline") - F.col("optimized")
    return runs.agg(F.avg(saved).alias("estimated_cost_reduction"), F.stddev_samp(saved).alias("between_run_std"))
