"""Report measures. Each function takes facts and grouping columns and returns one row per group.

Inventory measures belong to a single scenario world: where a group spans more than one service
level, policy or scenario, adding them up would mix worlds and the measure is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import month_start, ratio
from shelfline.operators.orders import order_categories, valid
from shelfline.operators.panel import SERIES, trailing
from shelfline.operators.policy import at_risk
from shelfline.operators.segments import revenue_shares

SCENARIO = ("target_service_level", "policy", "scenario")


def one_value(*columns: str) -> Column:
    """Aggregate condition: each column takes exactly one value in the group."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & (F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1)))
    return condition


def guarded(value: Column, *columns: str) -> Column:
    return F.when(one_value(*columns), value)


# --- panel --------------------------------------------------------------------------------------

def sales_measures(sales: DataFrame, *groups: str) -> DataFrame:
    return sales.groupBy(*groups).agg(
        F.sum("units_sold").alias("total_units_sold"), F.sum("revenue").alias("total_revenue"),
        ratio(F.sum("revenue"), F.sum("units_sold")).alias("average_selling_price"),
    )


def revenue_growth(sales: DataFrame, *groups: str) -> DataFrame:
    """Revenue per month next to that of the month before; null without such a month."""
    monthly = sales.groupBy(*groups, month_start("date").alias("month")).agg(F.sum("revenue").alias("total_revenue"))
    shifted = monthly.select(
        *groups, F.add_months("month", 1).alias("month"), F.col("total_revenue").alias("revenue_previous_period")
    )
    return monthly.join(shifted, [*groups, "month"], "left").withColumn(
        "revenue_growth", ratio(F.col("total_revenue") - F.col("revenue_previous_period"), "revenue_previous_period")
    )


def policy_measures(policy: DataFrame, *groups: str) -> DataFrame:
    level = "target_service_level"
    return policy.groupBy(*groups).agg(
        *[guarded(F.sum(c), level).alias(n) for c, n in (
            ("inventory_value", "inventory_value"), ("safety_stock", "safety_stock_units"),
            ("reorder_point", "reorder_point_units"), ("eoq", "eoq_units"), ("excess_value", "estimated_excess_inventory"))],
        guarded(ratio(F.sum("initial_inventory"), F.sum("forecast_daily_demand")), level).alias("days_of_supply"),
        guarded(F.count_if(at_risk(policy)), level).alias("pairs_at_stockout_risk"),
    )


RUN_SUMS = {
    "stockout_events": "stockout_event", "lost_sales_units": "lost_sales_units", "lost_sales_value": "lost_sales_value",
    "total_holding_cost": "holding_cost", "total_ordering_cost": "ordering_cost", "total_inventory_cost": "total_inventory_cost",
}


def replay_measures(ledger: DataFrame, *groups: str) -> DataFrame:
    """Sums within a run, then means over runs; rates from the sums of all runs.

    The ledger is read once and summed per day of each scenario world by hashing; the extrema of the
    scenario labels, which tell mixed worlds apart, are taken over that short table.
    """
    sums = {**RUN_SUMS, "fulfilled": "fulfilled_units", "demand": "actual_demand", "closing": "closing_inventory"}
    keys = list(dict.fromkeys([*groups, *SCENARIO, "run_id", "date"]))
    per_world = ledger.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()], F.count(F.lit(1)).alias("rows"))
    mixed = [c for c in SCENARIO if c not in groups]
    per_day = per_world.groupBy(*groups, "run_id", "date").agg(
        *[F.sum(n).alias(n) for n in (*sums, "rows")],
        *[F.min(c).alias(f"_min_{c}") for c in mixed], *[F.max(c).alias(f"_max_{c}") for c in mixed],
    )
    per_run = per_day.groupBy(*groups, "run_id").agg(
        *[F.sum(n).alias(n) for n in (*RUN_SUMS, "fulfilled", "demand", "closing", "rows")],
        F.count(F.lit(1)).alias("days"),
        *[F.min(f"_min_{c}").alias(f"_min_{c}") for c in SCENARIO if c not in groups],
        *[F.max(f"_max_{c}").alias(f"_max_{c}") for c in SCENARIO if c not in groups],
    )
    ready = F.lit(True)
    for c in SCENARIO:
        if c not in groups:
            ready = ready & (F.min(f"_min_{c}") == F.max(f"_max_{c}"))
    average_inventory = ratio(F.sum("closing"), F.sum("days"))
    measures = {
        **{n: F.avg(n) for n in RUN_SUMS},
        "stockout_rate": ratio(F.sum("stockout_events"), F.sum("rows")),
        "fill_rate": ratio(F.sum("fulfilled"), F.sum("demand")),
        "average_inventory": average_inventory,
        "inventory_turnover": ratio(F.avg("fulfilled"), average_inventory) * ratio(F.lit(365.0), F.max("days")),
    }
    return per_run.groupBy(*groups).agg(*[F.when(ready, m).alias(n) for n, m in measures.items()])


def cost_comparison(ledger: DataFrame, *groups: str) -> DataFrame:
    """Cost under either policy, mean over runs, and the reduction."""
    per_run = ledger.groupBy(*groups, "run_id").pivot("policy", ["baseline", "optimized"]).agg(F.sum("total_inventory_cost"))
    costs = per_run.groupBy(*groups).agg(
        F.avg("baseline").alias("baseline_inventory_cost"), F.avg("optimized").alias("optimized_inventory_cost")
    )
    saved = F.col("baseline_inventory_cost") - F.col("optimized_inventory_cost")
    return costs.withColumns({
        "estimated_cost_reduction": saved, "estimated_cost_reduction_share": ratio(saved, "baseline_inventory_cost"),
    })


# --- orders -------------------------------------------------------------------------------------

def delivery_measures(delivery: DataFrame, *groups: str) -> DataFrame:
    """The delivery fact has one row per order, so its rows are the distinct orders."""
    is_late = F.col("delivery_eligible") & (F.col("late_order") == 1)
    counted = delivery.groupBy(*groups).agg(
        F.count("order_id").alias("total_orders"), F.count_if("delivery_eligible").alias("eligible_orders"),
        F.count_if(is_late).alias("late_orders"),
        F.avg(F.when(F.col("delivery_eligible"), F.col("positive_delay_days"))).alias("average_delay_days"),
    )
    late = ratio("late_orders", "eligible_orders")
    return counted.withColumns({"late_delivery_share": late, "on_time_delivery_share": 1 - late})


def profit_measures(lines: DataFrame, *groups: str) -> DataFrame:
    """Totals of valid lines and orders whose lines of the group add up to a loss."""
    per_order = valid(lines).groupBy(*groups, "order_id").agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    return per_order.groupBy(*groups).agg(
        F.sum("sales").alias("total_sales"), F.sum("profit").alias("total_profit"),
        ratio(F.sum("profit"), F.sum("sales")).alias("profit_margin"),
        F.count_if(F.coalesce(F.col("profit") < 0, F.lit(False))).alias("loss_making_orders"),
    )


def orders_with_category(delivery: DataFrame, lines: DataFrame, category: str) -> DataFrame:
    """Deliveries of the orders that contain a category; the line fact acts as a filter only."""
    return delivery.join(lines.filter(F.col("category") == category).select("order_id"), "order_id", "left_semi")


def category_late_share(lines: DataFrame, delivery: DataFrame) -> DataFrame:
    """The same for every category at once."""
    facts = delivery.select("order_id", "delivery_eligible", "late_order")
    return order_categories(lines).join(facts, "order_id").groupBy("category").agg(
        ratio(F.count_if(F.col("delivery_eligible") & (F.col("late_order") == 1)), F.count_if("delivery_eligible"))
        .alias("category_late_delivery_share")
    )


def last_refresh(metadata: DataFrame) -> DataFrame:
    return metadata.agg(F.max("last_refresh_utc").alias("last_refresh"))


# --- page tables --------------------------------------------------------------------------------

def class_matrix(segments: DataFrame) -> DataFrame:
    return segments.groupBy("abc_xyz").agg(F.count(F.lit(1)).alias("pairs"))


def policy_trade_off(kpis: DataFrame, *groups: str) -> DataFrame:
    per_run = kpis.groupBy(*groups, "run_id").agg(*[
        F.sum(c).alias(c) for c in ("total_inventory_cost", "lost_sales_units", "fulfilled_units", "actual_demand")
    ])
    return per_run.groupBy(*groups).agg(
        F.avg("total_inventory_cost").alias("mean_cost"), F.avg("lost_sales_units").alias("mean_lost_units"),
        ratio(F.sum("fulfilled_units"), F.sum("actual_demand")).alias("fill_rate"),
    )


def sensitivity_line(sensitivity: DataFrame) -> DataFrame:
    return sensitivity.groupBy("scenario", "policy", "target_service_level").agg(
        F.avg("total_inventory_cost").alias("mean_cost")
    )


def item_revenue_pareto(sales: DataFrame) -> DataFrame:
    by_item = sales.groupBy("item_id").agg(F.sum("revenue").alias("revenue"))
    return revenue_shares(by_item, ["item_id"]).select("item_id", "revenue", "cumulative_share")


def loss_pareto(orders: DataFrame) -> DataFrame:
    """Cumulative share of the absolute loss, over loss-making orders only."""
    losses = orders.filter("loss_making_order").select("order_id", (-F.col("profit")).alias("loss"))
    return revenue_shares(losses, ["order_id"], "loss").select("order_id", "loss", "cumulative_share")


def decomposition(df: DataFrame, path: list[str], *measures: Column) -> DataFrame:
    """Totals along a path of dimensions, from the whole to the finest group."""
    return df.rollup(*path).agg(F.grouping_id().alias("level_id"), *measures)


def late_order_decomposition(delivery: DataFrame) -> DataFrame:
    return decomposition(
        delivery.filter("delivery_eligible"), ["shipping_mode", "market", "region"],
        F.count(F.lit(1)).alias("eligible_orders"), F.sum("late_order").alias("late_orders"),
    )


def profit_decomposition(lines: DataFrame) -> DataFrame:
    return decomposition(
        valid(lines), ["category", "market", "region", "customer_segment"],
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit"),
    )


def late_rate_against_margin(delivery: DataFrame, lines: DataFrame) -> DataFrame:
    """Both facts are summed to one row per shipping mode before they meet."""
    late = delivery.filter("delivery_eligible").groupBy("shipping_mode").agg(F.avg("late_order").alias("late_rate"))
    margin = valid(lines).groupBy("shipping_mode").agg(ratio(F.sum("profit"), F.sum("sales")).alias("margin"))
    return late.join(margin, "shipping_mode")


def category_trend(sales: DataFrame, *dimensions: str) -> DataFrame:
    return sales.groupBy(*dimensions, month_start("date").alias("month")).agg(
        F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue")
    )


def worst_orders(orders: DataFrame, n: int = 20) -> DataFrame:
    return orders.filter("loss_making_order").orderBy("profit", "order_id").limit(n).select("order_id", "sales", "profit")


def best_pairs(sales: DataFrame, n: int = 20) -> DataFrame:
    pairs = sales.groupBy(*SERIES).agg(F.sum("revenue").alias("revenue"))
    return pairs.orderBy(F.desc("revenue"), *SERIES).limit(n)


def drill_through(sales: DataFrame, forecast: DataFrame, policy: DataFrame, origin: Column, level: float) -> DataFrame:
    """Recent history, forecast with bounds and policy of a series as rows of one table."""
    past = trailing(sales, origin, 90).select(F.lit("history").alias("part"), *SERIES, "date", "units_sold")
    future = forecast.select(
        F.lit("forecast").alias("part"), *SERIES, "date", "forecast_units", "lower_80", "upper_80", "lower_95", "upper_95"
    )
    plan = policy.filter(F.col("target_service_level") == level).select(
        F.lit("policy").alias("part"), *SERIES, F.col("as_of_date").alias("date"), "safety_stock", "reorder_point"
    )
    return past.unionByName(future, allowMissingColumns=True).unionByName(plan, allowMissingColumns=True)


def executive_table(
    sales: DataFrame, forecast: DataFrame, kpis: DataFrame, delivery: DataFrame, orders: DataFrame,
    level: float, provenance: str,
) -> DataFrame:
    """Six headline metrics, labelled by domain and kind."""
    chosen = kpis.filter((F.col("policy") == "optimized") & (F.col("target_service_level") == level))
    saved = chosen.groupBy("run_id").agg(F.sum("estimated_cost_reduction").alias("saved"))
    totals = sales.agg(F.sum("units_sold").cast("double").alias("total_units"), F.sum("revenue").alias("revenue"))
    rows = [
        ("panel", "historical", None, totals.unpivot([], ["total_units", "revenue"], "metric", "value")),
        ("panel", "forecast", "forecast_28d_units", forecast.agg(F.sum("forecast_units").alias("value"))),
        ("panel", "scenario_estimate", "estimated_cost_reduction", saved.agg(F.avg("saved").alias("value"))),
        ("orders", "historical", "eligible_order_late_rate",
         delivery.filter("delivery_eligible").agg(F.avg("late_order").alias("value"))),
        ("orders", "historical", "profit", orders.agg(F.sum("profit").alias("value"))),
    ]
    out = None
    for domain, kind, metric, df in rows:
        part = df.select(
            F.lit(domain).alias("domain"), F.lit(kind).alias("metric_type"),
            (F.lit(metric) if metric else F.col("metric")).alias("metric"), F.col("value").cast("double").alias("value"),
            F.lit(provenance).alias("data_provenance"),
        )
        out = part if out is None else out.unionByName(part)
    return out


# --- recommendations ----------------------------------------------------------------------------

def _evidence(df: DataFrame, order: list[Column], domain: str, kind: str, action: Column, evidence: Column, source: str) -> DataFrame:
    """The first row of `df` in `order` as one recommendation."""
    return df.orderBy(*order).limit(1).select(
        F.lit(domain).alias("domain"), F.lit(kind).alias("evidence_type"), action.alias("recommendation"),
        evidence.alias("evidence"), F.lit(source).alias("source_table"),
    )


def recommendations(
    policy: DataFrame, accuracy: DataFrame, performance: DataFrame, events: DataFrame, shipping: DataFrame,
    profits: DataFrame, kpis: DataFrame, level: float, provenance: str,
) -> DataFrame:
    """One suggested action per finding, each with the numbers it rests on."""
    from shelfline.operators.ordered import exact_quantiles

    text, name = F.format_string, F.concat_ws("/", *SERIES)
    chosen = policy.filter(F.col("target_service_level") == level)
    parts = [
        _evidence(
            chosen, [F.desc("stockout_probability"), *map(F.col, SERIES)], "panel", "scenario",
            F.concat(F.lit("Check the starting stock and consider a larger buffer for "), name),
            text("Modeled stockout probability %.4f; safety stock %.2f units", "stockout_probability", "safety_stock"), "policy"),
        _evidence(
            chosen.filter("excess_value > 0"), [F.desc("excess_value"), *map(F.col, SERIES)], "panel", "scenario",
            F.concat(F.lit("Consider lower replenishment for "), name),
            text("Assumed excess %.2f units, value %.2f", "excess_units", "excess_value"), "policy"),
        _evidence(
            accuracy.filter("segment_type = 'store_id'"), [F.desc_nulls_last("wape"), F.col("segment")], "panel", "forecast_evaluation",
            F.concat(F.lit("Look first at forecast errors in store "), F.col("segment")),
            text("Held-out WAPE %.4f", "wape"), "segment_metrics"),
        _evidence(
            performance.agg(F.count_if(F.col("xyz") == "Z").alias("z"), F.count(F.lit(1)).alias("n")).filter("z > 0"),
            [F.col("z")], "panel", "historical", F.lit("Try intermittent-demand methods for Z items"),
            text("%d of %d item-store pairs are in class Z", "z", "n"), "segments"),
        _evidence(
            chosen.groupBy("category_id").agg(F.avg("safety_stock").alias("mean")), [F.desc("mean"), F.col("category_id")],
            "panel", "scenario", F.concat(F.lit("Consider separate buffers for category "), F.col("category_id")),
            text("Mean safety stock %.2f units", "mean"), "policy"),
        _evidence(
            events.filter("segment IS NOT NULL"), [F.desc("mean_series_day_units"), F.col("segment")], "panel", "historical",
            F.concat(F.lit("Prepare for the event "), F.col("segment")),
            text("Mean %.3f units per series-day over %d observations, not adjusted for season", "mean_series_day_units", "series_days"),
            "dimension_profiles"),
    ]
    for dimension in ("shipping_mode", "market"):
        parts.append(_evidence(
            shipping.filter((F.col("dimension") == dimension) & F.col("late_delivery_rate").isNotNull()),
            [F.desc("late_delivery_rate"), F.col("segment")], "orders", "historical",
            F.concat(F.lit("Review promises and capacity for "), F.col("segment")),
            text("%d of %d eligible orders late (%.4f); association only", "late_orders", "eligible_orders", "late_delivery_rate"),
            "delivery_summary"))
    categories = profits.filter("dimension = 'category'")
    threshold = exact_quantiles(categories, [], "sales", {"p75": 0.75}).select("p75").scalar()
    parts.append(_evidence(
        categories.filter(F.col("sales") >= threshold), [F.asc_nulls_last("profit_margin"), F.col("segment")], "orders", "historical",
        F.concat(F.lit("Review pricing, mix and discounts for "), F.col("segment")),
        text("Top-quartile sales %.2f, margin %.4f", "sales", "profit_margin"), "profit_summary"))
    per_run = kpis.filter("policy = 'optimized'").groupBy("target_service_level", "run_id").agg(
        F.sum("estimated_cost_reduction").alias("saved"), F.sum("fulfilled_units").alias("fulfilled"), F.sum("actual_demand").alias("demand"))
    per_level = per_run.groupBy("target_service_level").agg(
        F.avg("saved").alias("saved"), ratio(F.sum("fulfilled"), F.sum("demand")).alias("fill"))
    parts.append(per_level.select(
        F.lit("panel").alias("domain"), F.lit("scenario").alias("evidence_type"),
        text("Compare cost and service before choosing the %.0f%% target", F.col("target_service_level") * 100).alias("recommendation"),
        text("Paired cost reduction %.2f; demand-weighted fill rate %.4f", "saved", "fill").alias("evidence"),
        F.lit("ledger_kpis").alias("source_table")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("data_provenance", F.lit(provenance))
