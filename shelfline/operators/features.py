"""Past-only time-series features.

Every window is partitioned by series. A series holds one row per day (a rule of the panel), so a
window partition is as long as the calendar and does not grow with the number of series.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.columns import ratio
from shelfline.operators.panel import SERIES

LAGS = (1, 7, 14, 28, 56)
MEAN_DAYS = (7, 28, 56)
SPREAD_DAYS = (7, 28)
NUMERIC = (
    *(f"lag_{k}" for k in LAGS), *(f"rolling_mean_{k}" for k in MEAN_DAYS),
    *(f"rolling_std_{k}" for k in SPREAD_DAYS), "sell_price", "price_change_percentage", "weekday", "week",
    "month", "quarter", "event_flag", "snap_flag", "days_since_last_sale",
)
CATEGORICAL = ("item_id", "store_id", "state_id", "category_id", "department_id", "event_type")


def by_date():
    return Window.partitionBy(*SERIES).orderBy("date")


def past(days: int):
    """The rows before this one, `days` at most."""
    return by_date().rowsBetween(-days, -1)


def lags() -> dict:
    return {f"lag_{k}": F.lag("units_sold", k).over(by_date()) for k in LAGS}


def rolling_means() -> dict:
    return {f"rolling_mean_{k}": F.avg("units_sold").over(past(k)) for k in MEAN_DAYS}


def rolling_spreads() -> dict:
    columns = {}
    for k in SPREAD_DAYS:
        columns[f"rolling_std_{k}"] = F.stddev_samp("units_sold").over(past(k))
        columns[f"rolling_{k}_day_units"] = F.sum("units_sold").over(past(k))
        columns[f"rolling_{k}_day_revenue"] = F.sum("revenue").over(past(k))
    return columns


def price_change() -> dict:
    return {"price_change_percentage": ratio("sell_price", F.lag("sell_price").over(by_date())) - 1}


def days_since_last_sale() -> dict:
    earlier = by_date().rowsBetween(Window.unboundedPreceding, -1)
    sold_on = F.max(F.when(F.col("units_sold") > 0, F.col("date"))).over(earlier)
    return {"days_since_last_sale": F.datediff("date", sold_on)}


def add_features(sales: DataFrame) -> DataFrame:
    """All features in one pass: the windows share partitioning and order, so there is one sort."""
    return sales.withColumns({
        "week": F.weekofyear("date"),
        **lags(), **rolling_means(), **rolling_spreads(), **price_change(), **days_since_last_sale(),
    })


def recent_features(sales: DataFrame, after: dt.date, until: dt.date) -> DataFrame:
    """The features of the days after `after` up to `until`, from those days and the longest lag before them alone. What lies
    further back enters as one row per series: the day of its last sale."""
    start = after - dt.timedelta(days=max(*LAGS, *MEAN_DAYS) + 1)
    date = F.col("date")
    read = sales.filter((date > F.lit(start)) & (date <= F.lit(until)) & F.col("year").between(start.year, until.year))
    before = sales.filter((date <= F.lit(start)) & (F.col("year") <= start.year) & (F.col("units_sold") > 0)).groupBy(*SERIES).agg(
        F.max("date").alias("_sold_before"))
    featured = add_features(read).filter(date > F.lit(after)).join(before, SERIES, "left")
    return featured.withColumn("days_since_last_sale", F.coalesce("days_since_last_sale", F.datediff("date", "_sold_before"))).drop("_sold_before")


def error_scale_parts(sales: DataFrame) -> DataFrame:
    """Squared day-to-day change of each day after the first sale of its series (null before it)."""
    series = Window.partitionBy(*SERIES)
    first_sale = F.min(F.when(F.col("units_sold") != 0, F.col("date"))).over(series)
    step = F.col("units_sold") - F.lag("units_sold").over(by_date())
    return sales.withColumn("squared_step", F.when(F.col("date") > first_sale, step * step))


def error_scale(sales: DataFrame) -> DataFrame:
    """Mean squared change after the first sale; null without a change to measure."""
    mean = F.avg("squared_step")
    return error_scale_parts(sales).groupBy(*SERIES).agg(F.when(mean > 0, mean).alias("scale"))


def training_sample(features: DataFrame, rows: int, seed: int) -> DataFrame:
    """The `rows` rows with the smallest hashes of their key, or all if there are fewer: the same rows whatever the layout. Rows
    with equal keys come in or stay out together.

    A histogram over the leading digits of the hash shows the bin in which the last row lies; that bin alone is counted by its
    next digits, until the cut falls between two bins. What is left is a filter: no task sorts or holds the sample.
    """
    digits, key = 3, F.md5(F.concat_ws("|", "item_id", "store_id", F.col("date").cast("string"), F.lit(str(seed))))
    cut, before = "", 0
    while len(cut) < 32:
        inside = features.select(key.alias("_key")).filter(F.col("_key").startswith(cut))
        bins = inside.groupBy(F.substring("_key", 1, len(cut) + digits).alias("bin")).count()
        found = bins.orderBy("bin").collect()  # at most 16 ** digits rows
        past = False
        for r in found:
            if before + r["count"] >= rows:
                cut, past = r["bin"], True
                break
            before += r["count"]
        if not past:
            return features
        if before + r["count"] == rows:
            break
    return features.filter(F.substring(key, 1, len(cut)) <= cut) if rows else features.limit(0)
