"""Inventory assumptions and replenishment policies, as column arithmetic over one row per series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import col, hashed_draw, holds, normal_cdf, normal_quantile, ratio
from shelfline.operators.panel import SERIES
from shelfline.operators.quality import QualityError, require_none, require_unique
from shelfline.settings import DEFAULTS, Settings

POSITIVE = (
    "estimated_unit_cost", "annual_holding_cost_rate", "case_pack_size", "review_period_days", "average_lead_time_days",
)
NOT_NEGATIVE = (
    "initial_inventory", "lead_time_standard_deviation", "ordering_cost_per_order", "lost_sale_penalty",
    "minimum_order_quantity",
)
# One factor at a time; `forecast_error` scales the error spread, the others an assumption.
SENSITIVITY_FACTORS = (
    "average_lead_time_days", "lead_time_standard_deviation", "annual_holding_cost_rate", "ordering_cost_per_order",
    "forecast_error", "lost_sale_penalty",
)
BASE_CASE = (("base", "none", 1.0),)


def sensitivity_cases(factors: Sequence[float] = (0.5, 1.5)) -> tuple[tuple[str, str, float], ...]:
    return BASE_CASE + tuple((f"{n}_{f}", n, f) for n in SENSITIVITY_FACTORS for f in factors)


def create_assumptions(history: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Assumed inputs per series. The lead time is drawn from a hash of the series key."""
    shortest, longest = settings.lead_time_days
    draw = hashed_draw(longest - shortest + 1, "item_id", "store_id", F.lit(settings.seed))
    number = lambda x: F.lit(float(x))
    return history.select(
        *SERIES, F.concat(F.lit("SUP_"), "category_id").alias("supplier_id"),
        (F.lit(shortest) + draw).cast("double").alias("average_lead_time_days"),
        number(settings.lead_time_std_days).alias("lead_time_standard_deviation"),
        number(settings.ordering_cost).alias("ordering_cost_per_order"),
        number(settings.holding_rate).alias("annual_holding_cost_rate"),
        F.when(F.col("last_price").isNotNull(), F.greatest(F.lit(0.01), F.col("last_price") * settings.cost_to_price)).alias("estimated_unit_cost"),
        number(settings.default_service_level).alias("target_service_level"),
        F.ceil(F.col("average_daily_demand") * settings.initial_days_supply).cast("double").alias("initial_inventory"),
        number(settings.review_period_days).alias("review_period_days"),
        (F.col("last_price") * settings.penalty_to_price).alias("lost_sale_penalty"),
        number(settings.minimum_order_quantity).alias("minimum_order_quantity"),
        number(settings.case_pack_size).alias("case_pack_size"),
        F.lit("simulated").alias("assumption_type"), F.lit(settings.seed).alias("seed"),
    )


def recorded_lead_times(durations: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Lead times per series from recorded durations (item, store, `days`, and `lines`, how many took them), for `override`.

    A series' mean is drawn towards the mean over all durations as far as its own few durations leave it uncertain (empirical
    Bayes: the variance between series against the variance inside them); its variance counts as that of `lead_time_prior` more
    durations with the common variance. Durations that are null, negative or beyond the longest plausible one don't count. Sums of
    whole days are exact, so the result does not depend on the layout; one aggregate by series, and one row of totals on the driver.
    Columns: the series, recorded_durations, average_lead_time_days, lead_time_standard_deviation. Without a pair of durations in
    any series, or without variance, means are left as they are. Without durations there are no rows.
    """
    days, lines = F.col("days").cast("long"), F.col("lines")
    per_series = durations.filter(F.col("days").between(0, settings.maximum_shipping_days) & (lines > 0)).groupBy(*SERIES).agg(
        F.sum(lines).alias("n"), F.sum(days * lines).alias("s"), F.sum(days * days * lines).alias("q"))
    n, s, q = (F.col(c).cast("double") for c in "nsq")
    total = per_series.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(s * s / n).alias("explained")).first()
    mean = inside = between = 0.0
    if total["n"]:
        mean = total["s"] / total["n"]
        if total["n"] > total["k"]:
            inside = max(0.0, (total["q"] - total["explained"]) / (total["n"] - total["k"]))
        spread = total["n"] - total["nn"] / total["n"]
        if spread > 0:
            between = max(0.0, (total["explained"] - total["s"] * mean - (total["k"] - 1) * inside) / spread)
    own = n * between / (n * between + inside) if inside > 0 else F.lit(1.0)
    prior = float(settings.lead_time_prior)
    variance = (q - s * s / n + prior * inside) / (n - 1.0 + prior)
    return per_series.select(
        *SERIES, F.col("n").alias("recorded_durations"), (own * (s / n) + (1.0 - own) * mean).alias("average_lead_time_days"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("lead_time_standard_deviation"))


def override(base: DataFrame, supplied: DataFrame, keys: Sequence[str] = tuple(SERIES)) -> DataFrame:
    """Supplied cells replace those of `base` where they are not null; other cells stay."""
    require_unique(supplied, keys, "supplied assumptions")
    shared = [c for c in supplied.columns if c in base.columns and c not in keys]
    given = supplied.select(*keys, *[F.col(c).alias(f"_given_{c}") for c in shared])
    return base.join(given, list(keys), "left").select(*[
        F.coalesce(F.col(f"_given_{c}"), F.col(c)).alias(c) if c in shared else F.col(c) for c in base.columns
    ])


def input_violations(assumptions: DataFrame) -> DataFrame:
    """Rows no policy may be computed from."""
    bad = F.lit(False)
    for c in POSITIVE:
        bad = bad | F.col(c).isNull() | (F.col(c) <= 0)
    for c in NOT_NEGATIVE:
        bad = bad | F.col(c).isNull() | (F.col(c) < 0)
    return assumptions.filter(bad)


def require_service_levels(levels: Sequence[float]) -> None:
    if any(not 0 < p < 1 for p in levels):
        raise QualityError("a service level has to lie between 0 and 1")


def require_inputs(assumptions: DataFrame, levels: Sequence[float]) -> None:
    require_service_levels(levels)
    require_none(input_violations(assumptions), "invalid inventory assumption")


def demand_spread(mean, sd, lead, lead_sd) -> Column:
    """Standard deviation of demand over an uncertain lead time."""
    mean, sd, lead, lead_sd = col(mean), col(sd), col(lead), col(lead_sd)
    return F.sqrt(lead * sd * sd + mean * mean * lead_sd * lead_sd)


def safety_stock(mean, sd, lead, lead_sd, z) -> Column:
    return col(z) * demand_spread(mean, sd, lead, lead_sd)


def economic_quantity(annual_demand, ordering_cost, holding_cost) -> Column:
    return F.sqrt(2 * col(annual_demand) * col(ordering_cost) / F.nullif(col(holding_cost).cast("double"), F.lit(0.0)))


def round_to_lots(quantity, minimum, pack) -> Column:
    """Whole packs, the minimum at least; nothing when nothing is needed."""
    packs = F.ceil(F.greatest(col(quantity), col(minimum)) / col(pack))
    return F.when(col(quantity) > 0, (packs * col(pack)).cast("double")).otherwise(F.lit(0.0))


def stockout_probability(stock, lead_demand, spread) -> Column:
    """Chance that demand over the lead time exceeds the stock; certain knowledge without spread."""
    stock, lead_demand, spread = col(stock), col(lead_demand), col(spread)
    z = (stock - lead_demand) / F.nullif(spread, F.lit(0.0))
    return F.when(spread > 0, 1.0 - normal_cdf(z)).otherwise((stock < lead_demand).cast("double"))


def compute_policies(
    history: DataFrame, forecasts: DataFrame, assumptions: DataFrame, errors: DataFrame,
    levels: Sequence[float], as_of: dt.date, cases: Sequence[tuple[str, str, float]] = BASE_CASE,
) -> DataFrame:
    """One policy row per series, service level and case.

    The four inputs join on the series, one row each; levels and cases are literals that are exploded
    from the joined row, so the whole grid is one job.
    """
    require_service_levels(levels)
    means = forecasts.groupBy(*SERIES).agg(F.avg("forecast_units").alias("forecast_daily_demand"))
    spreads = errors.groupBy(*SERIES).agg(F.stddev_samp("error").alias("forecast_error_std"))
    joined = (
        history.join(assumptions.drop("target_service_level"), SERIES)
        .join(means, SERIES).join(spreads, SERIES, "left")
    )
    level_rows = F.array(*[
        F.struct(F.lit(float(p)).alias("target_service_level"), F.lit(normal_quantile(p)).alias("z")) for p in levels
    ])
    case_rows = F.array(*[
        F.struct(F.lit(s).alias("scenario"), F.lit(n).alias("sensitivity_factor"), F.lit(float(f)).alias("multiplier"))
        for s, n, f in cases
    ])
    grid = joined.select("*", F.inline(level_rows)).select("*", F.inline(case_rows))
    scale = lambda name: F.when(F.col("sensitivity_factor") == name, F.col("multiplier")).otherwise(1.0)
    if len(cases) > 1:
        grid = grid.withColumns({n: F.col(n) * scale(n) for n in SENSITIVITY_FACTORS if n != "forecast_error"})
        grid = grid.withColumn("forecast_error_std", F.col("forecast_error_std") * scale("forecast_error"))

    mean, sd = F.col("forecast_daily_demand"), F.col("demand_uncertainty_std")
    lead, lead_sd = F.col("average_lead_time_days"), F.col("lead_time_standard_deviation")
    cover = lead + F.col("review_period_days")
    stock = F.col("initial_inventory")
    with_stocks = grid.withColumn(
        "demand_uncertainty_std", F.coalesce("forecast_error_std", "demand_std")
    ).withColumns({
        "as_of_date": F.lit(as_of),
        "_spread": demand_spread(mean, sd, lead, lead_sd),
        "safety_stock": safety_stock(mean, sd, lead, lead_sd, "z"),
        "expected_lead_time_demand": mean * lead,
        "protection_safety_stock": safety_stock(mean, sd, cover, lead_sd, "z"),
        "eoq": economic_quantity(
            mean * 365, "ordering_cost_per_order", F.col("estimated_unit_cost") * F.col("annual_holding_cost_rate")),
        "days_of_supply": ratio(stock, mean),
        "inventory_value": stock * F.col("estimated_unit_cost"),
    }).withColumns({
        "reorder_point": F.col("expected_lead_time_demand") + F.col("safety_stock"),
        "order_up_to_level": mean * cover + F.col("protection_safety_stock"),
    })
    gap = F.col("order_up_to_level") - stock
    return with_stocks.withColumns({
        "stockout_probability": stockout_probability(stock, "expected_lead_time_demand", "_spread"),
        "recommended_order_quantity": F.when(
            gap > 0, round_to_lots(F.greatest(F.col("eoq"), gap), "minimum_order_quantity", "case_pack_size")
        ).otherwise(F.lit(0.0)),
        "excess_units": F.greatest(F.lit(0.0), -gap),
        "excess_value": F.greatest(F.lit(0.0), -gap) * F.col("estimated_unit_cost"),
    }).drop("_spread")


def at_risk(policy: DataFrame) -> Column:
    return holds(F.col("stockout_probability") > 1 - F.col("target_service_level"))
