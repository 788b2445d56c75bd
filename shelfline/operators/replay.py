"""Replay of replenishment policies over a demand window.

A world is one series under one policy, scenario, service level and run. Its days are an ordered
fold: the stock of a day depends on every earlier day. The days of a world form one short array (the
window's length, whatever the number of series), the fold is a built-in `aggregate` over it, and
worlds are spread over the cluster like any rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import hashed_draw, ratio
from shelfline.operators.panel import SERIES
from shelfline.operators.policy import round_to_lots
from shelfline.settings import DEFAULTS, Settings

POLICIES = ("baseline", "optimized")
WORLD = [*SERIES, "policy", "scenario", "target_service_level", "run_id"]
PAIR = [*SERIES, "scenario", "target_service_level", "run_id"]
_PARAMETERS = (
    "initial_inventory", "average_daily_demand", "average_lead_time_days", "lead_time_standard_deviation",
    "review_period_days", "minimum_order_quantity", "case_pack_size", "eoq", "protection_safety_stock",
    "estimated_unit_cost", "annual_holding_cost_rate", "ordering_cost_per_order", "lost_sale_penalty", "last_price",
)


def hashed_lead_draws(series: DataFrame, runs: int, days: int) -> DataFrame:
    """Standardised lead-time draws per series, run and day: an evenly spread value with mean 0 and
    variance 1, from a hash of its key. Both policies of a pair meet the same draws."""
    draw = hashed_draw(4001, "item_id", "store_id", "run_id", "day") / 2000.0 - 1.0
    return (
        series.select(*SERIES).distinct()
        .withColumn("run_id", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))
        .withColumn("day", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
        .withColumn("z", draw * 1.7320508075688772)
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it under a name."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(orders: Column) -> Column:
    return F.aggregate(orders, F.lit(0.0), lambda total, o: total + o["q"])


def _one_day(state: Column, x: Column) -> Column:
    """Receive, serve, review and order; returns the next state with the day appended to `out`."""

    def receive(arrivals: Column) -> Column:
        stock = state["on_hand"] + arrivals
        served = F.least(stock, x["demand"])
        return F.struct(
            arrivals.alias("arrivals"), served.alias("served"), (x["demand"] - served).alias("lost"),
            (stock - served).alias("closing"), F.filter(state["open"], lambda o: o["t"] > x["day"]).alias("open"),
            ((arrivals > 0) & state["started"]).alias("completed"),
            ((arrivals > 0) & state["started"] & ~state["loss"]).alias("successful"),
            (F.when(arrivals > 0, F.lit(False)).otherwise(state["loss"]) | (x["demand"] > served)).alias("loss"),
            (state["started"] | (arrivals > 0)).alias("started"),
        )

    def place(now: Column, position: Column) -> Column:
        gap = F.col("_target_base") - position
        baseline = round_to_lots(gap, "minimum_order_quantity", "case_pack_size")
        ahead = x["target"] - position
        optimized = F.when(
            ahead > 0, round_to_lots(F.greatest(F.col("eoq"), ahead), "minimum_order_quantity", "case_pack_size")
        ).otherwise(F.lit(0.0))
        review = x["day"] % F.col("review_period_days").cast("int") == 0
        return F.when(review, F.when(F.col("policy") == "baseline", baseline).otherwise(optimized)).otherwise(F.lit(0.0))

    def next_state(now: Column, transit: Column, order: Column) -> Column:
        placed = F.struct((x["day"] + x["lead"]).cast("int").alias("t"), order.alias("q"))
        still_open = F.when(order > 0, F.concat(now["open"], F.array(placed))).otherwise(now["open"])
        row = F.struct(
            x["date"].alias("date"), x["pred"].alias("forecast_demand"), x["demand"].alias("actual_demand"),
            state["on_hand"].alias("opening_inventory"), now["arrivals"].alias("arrivals"),
            now["served"].alias("fulfilled_units"), now["lost"].alias("lost_sales_units"),
            order.alias("order_quantity"), (transit + order).alias("in_transit_units"),
            now["closing"].alias("closing_inventory"), now["completed"].cast("int").alias("completed_cycles"),
            now["successful"].cast("int").alias("successful_cycles"),
        )
        return F.struct(
            now["closing"].alias("on_hand"), still_open.alias("open"), now["loss"].alias("loss"),
            now["started"].alias("started"), F.concat(state["out"], F.array(row)).alias("out"),
        )

    due = _total(F.filter(state["open"], lambda o: o["t"] == x["day"]))
    return _let(_let(due, receive), lambda now: _let(_total(now["open"]), lambda transit: _let(
        _let(now["closing"] + transit, lambda position: place(now, position)),
        lambda order: next_state(now, transit, order),
    )))


_ROW_TYPE = (
    "struct<date:date,forecast_demand:double,actual_demand:double,opening_inventory:double,arrivals:double,"
    "fulfilled_units:double,lost_sales_units:double,order_quantity:double,in_transit_units:double,"
    "closing_inventory:double,completed_cycles:int,successful_cycles:int>"
)


def replay(
    demand: DataFrame, policies: DataFrame, lead_draws: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Daily ledger of every world.

    `demand` has item_id, store_id, date, actual_units and forecast_units; `policies` one row per
    series, scenario and service level; `lead_draws` standardised draws per series, run and day.
    """
    windows = demand.groupBy(*SERIES).agg(F.array_sort(F.collect_list(F.struct(
        "date", F.col("actual_units").cast("double").alias("demand"), F.col("forecast_units").alias("pred")
    ))).alias("window"))
    draws = lead_draws.groupBy(*SERIES, "run_id").agg(
        F.array_sort(F.collect_list(F.struct("day", "z")))["z"].alias("draws")
    )
    kept = [c for c in ("scenario", "sensitivity_factor", "multiplier") if c in policies.columns]
    if "scenario" not in kept:
        policies, kept = policies.withColumn("scenario", F.lit("base")), ["scenario", *kept]
    worlds = (
        policies.select(*SERIES, "target_service_level", *kept, *_PARAMETERS)
        .join(windows, SERIES).join(draws, SERIES)
        .withColumn("policy", F.explode(F.array(*[F.lit(p) for p in POLICIES])))
    )
    # The fold is work per row, not per byte: a fixed partition count keeps adaptive execution from
    # gathering these small rows into a few tasks.
    partitions = int(demand.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    worlds = worlds.repartition(partitions, *WORLD)
    ahead = F.ceil(F.col("average_lead_time_days") + F.col("review_period_days")).cast("int")
    preds = F.col("window")["pred"]

    def day(x: Column, i: Column) -> Column:
        # Forecasts of the protection window after this day, padded with the last one.
        future = F.slice(preds, i + 2, F.col("_ahead"))
        target = F.aggregate(future, F.lit(0.0), lambda total, p: total + p) + (
            F.col("_ahead") - F.size(future)) * F.element_at(preds, -1) + F.col("protection_safety_stock")
        lead = F.greatest(F.lit(1.0), F.rint(
            F.col("average_lead_time_days") + F.col("lead_time_standard_deviation") * F.get("draws", i)))
        return F.struct(
            i.alias("day"), x["date"].alias("date"), x["demand"].alias("demand"), x["pred"].alias("pred"),
            lead.cast("int").alias("lead"), target.alias("target"),
        )

    start = F.struct(
        F.col("initial_inventory").cast("double").alias("on_hand"),
        F.array().cast("array<struct<t:int,q:double>>").alias("open"), F.lit(False).alias("loss"),
        F.lit(False).alias("started"), F.array().cast(f"array<{_ROW_TYPE}>").alias("out"),
    )
    prepared = worlds.withColumns({
        "_ahead": ahead, "_target_base": F.col("average_daily_demand") * settings.baseline_days_cover,
    }).withColumn("days", F.transform("window", day)).drop("window", "draws")
    ledger = prepared.select(
        "*", F.inline(F.aggregate("days", start, _one_day, lambda s: s["out"]))
    ).drop("days", "_ahead", "_target_base")
    lost = F.col("lost_sales_units")
    return ledger.withColumns({
        "stockout_event": (lost > 0).cast("int"),
        "holding_cost": F.col("closing_inventory") * F.col("estimated_unit_cost") * F.col("annual_holding_cost_rate") / 365,
        "ordering_cost": F.when(F.col("order_quantity") > 0, F.col("ordering_cost_per_order")).otherwise(F.lit(0.0)),
        "lost_sale_cost": lost * F.col("lost_sale_penalty"),
        "lost_sales_value": lost * F.col("last_price"),
    }).withColumn(
        "total_inventory_cost", F.col("holding_cost") + F.col("ordering_cost") + F.col("lost_sale_cost")
    ).select(
        *WORLD, *[c for c in kept if c != "scenario"], "date", "opening_inventory", "arrivals", "forecast_demand",
        "actual_demand", "fulfilled_units", "lost_sales_units", "order_quantity", "in_transit_units",
        "closing_inventory", "stockout_event", "holding_cost", "ordering_cost", "lost_sale_cost",
        "total_inventory_cost", "lost_sales_value", "completed_cycles", "successful_cycles",
    )


def ledger_kpis(ledger: DataFrame) -> DataFrame:
    """One row per world, next to the baseline of the same pair.

    The two policies of a pair are grouped together to carry the baseline over; a pair is two rows.
    """
    keys = WORLD + [c for c in ("sensitivity_factor", "multiplier") if c in ledger.columns]
    sums = ledger.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("actual_demand", "fulfilled_units", "lost_sales_units", "lost_sales_value")],
        F.avg("closing_inventory").alias("average_inventory"), F.max("closing_inventory").alias("maximum_inventory"),
        F.sum("stockout_event").alias("stockout_days"),
        *[F.sum(c).alias(c) for c in (
            "holding_cost", "ordering_cost", "lost_sale_cost", "total_inventory_cost", "completed_cycles", "successful_cycles")],
        F.count(F.lit(1)).alias("days"),
    )
    baseline = sums.filter("policy = 'baseline'").select(
        *PAIR, F.col("total_inventory_cost").alias("baseline_cost"), F.col("lost_sales_value").alias("baseline_lost_sales_value")
    )
    return sums.join(baseline, PAIR).withColumns({
        "fill_rate": ratio("fulfilled_units", "actual_demand"),
        "cycle_service_level": ratio("successful_cycles", "completed_cycles"),
        "inventory_turnover": ratio("fulfilled_units", "average_inventory") * 365 / F.col("days"),
        "estimated_cost_reduction": F.col("baseline_cost") - F.col("total_inventory_cost"),
        "estimated_revenue_protected": F.col("baseline_lost_sales_value") - F.col("lost_sales_value"),
    })
