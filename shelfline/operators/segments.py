"""ABC, XYZ and volume classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import ratio
from shelfline.operators.ordered import average_percent_ranked, running_totals
from shelfline.operators.panel import SERIES
from shelfline.settings import DEFAULTS, Settings


def revenue_shares(df: DataFrame, keys: Sequence[str], value: str = "revenue") -> DataFrame:
    """Add `prior_share` and `cumulative_share` of `value`, largest first, ties by key."""
    totals = running_totals(df, [F.col(value).desc(), *[F.col(k).asc() for k in keys]], [value])
    return totals.select(
        *df.columns,
        ratio(f"prior_{value}", f"total_{value}").alias("prior_share"),
        ratio(F.col(f"prior_{value}") + F.col(value), f"total_{value}").alias("cumulative_share"),
    )


def abc_class(prior_share: Column, settings: Settings = DEFAULTS) -> Column:
    """The item that crosses a boundary still belongs to the better class. A total of zero leaves
    the share null and the class C."""
    a, b = settings.abc_shares
    return F.when(prior_share < a, "A").when(prior_share < b, "B").otherwise("C")


def xyz_class(zero_share: Column, cv: Column, settings: Settings = DEFAULTS) -> Column:
    x, y = settings.xyz_cv
    return (
        F.when(zero_share >= settings.intermittent_zero_share, "Z").when(cv <= x, "X").when(cv <= y, "Y").otherwise("Z")
    )


def variability(df: DataFrame, keys: Sequence[str] = tuple(SERIES)) -> DataFrame:
    """Revenue, coefficient of variation and share of days without sales."""
    return df.groupBy(*keys).agg(
        F.sum("revenue").alias("revenue"),
        ratio(F.stddev_samp("units_sold"), F.avg("units_sold")).alias("cv"),
        F.avg(F.when(F.col("units_sold") == 0, 1.0).otherwise(0.0)).alias("zero_share"),
    )


def segmentation(history: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add every class to a history summary."""
    cv = ratio("demand_std", "average_daily_demand")
    shared = revenue_shares(history, SERIES).withColumn("coefficient_of_variation", cv)
    classed = shared.withColumns({
        # A negative total would flip the comparison: every series is C then as well.
        "abc": F.when(F.col("cumulative_share").isNull(), "C").otherwise(abc_class(F.col("prior_share"), settings)),
        "xyz": xyz_class(F.col("zero_demand_share"), F.col("coefficient_of_variation"), settings),
    }).withColumn("abc_xyz", F.concat_ws("-", "abc", "xyz"))
    ranked = average_percent_ranked(classed, "average_daily_demand", "_rank")
    third = 1.0 / 3.0
    return ranked.select(
        *history.columns, "coefficient_of_variation", "abc", "xyz", "abc_xyz",
        F.when(F.col("_rank") <= third, "low").when(F.col("_rank") <= 2 * third, "medium").otherwise("high")
        .alias("volume_segment"),
        F.col("cumulative_share").alias("cumulative_revenue_share"),
    )
