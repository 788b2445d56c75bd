"""Daily retail panel: wide to long, calendar and price joins, cohort choice, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import date_key, flag, month_start, ratio, sunday_zero_weekday, week_start
from shelfline.operators.quality import day_columns
from shelfline.settings import DEFAULTS, Settings

SERIES = ["item_id", "store_id"]
SERIES_ATTRIBUTES = ["item_id", "store_id", "category_id", "department_id", "state_id"]


def unpivot_days(wide: DataFrame) -> DataFrame:
    """One row per series and day column.

    The day columns become one array that is exploded. `DataFrame.unpivot` plans one projection per
    column, which for years of days is too much code to compile and ran 2.5 times longer.
    """
    days = day_columns(wide)
    ids = [c for c in wide.columns if c not in set(days)]
    units = F.expr(f"array({', '.join(f'CAST({c} AS BIGINT)' for c in days)})")
    names = F.split(F.lit(",".join(days)), ",")
    return wide.select(*ids, F.posexplode(units).alias("_n", "units_sold")).select(
        *ids, F.element_at(names, F.col("_n") + 1).alias("d"), "units_sold"
    )


def revenue_of(units: Column, price: Column) -> Column:
    """A day without sales earns nothing, also where no price is listed."""
    return F.when(units == 0, F.lit(0.0)).otherwise(units * price)


def join_calendar(demand: DataFrame, calendar: DataFrame) -> DataFrame:
    """Demand with its calendar day. The calendar has one row per day whatever the number of
    series, hence the broadcast."""
    return demand.join(F.broadcast(calendar.withColumn("date", F.col("date").cast("date"))), "d", "left")


def join_prices(dated: DataFrame, prices: DataFrame) -> DataFrame:
    """Add the weekly price. Prices grow with the panel; a join group is one week of one series."""
    return dated.join(prices.select(*SERIES, "wm_yr_wk", "sell_price"), [*SERIES, "wm_yr_wk"], "left")


def build_sales(demand: DataFrame, calendar: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Long panel: one row per series and day, with price, revenue, calendar fields and flags. Without `prices`, `demand` has its
    `sell_price`."""
    priced = ["sell_price"] if prices is None else []
    demand = demand.select(
        F.col("id").alias("series_id"), "item_id", F.col("dept_id").alias("department_id"),
        F.col("cat_id").alias("category_id"), "store_id", "state_id", "d", "units_sold", *priced,
    )
    dated = join_calendar(demand, calendar)
    joined = dated if prices is None else join_prices(dated, prices)
    date, units = F.col("date"), F.col("units_sold")
    weekday = sunday_zero_weekday(date)
    snap = F.when(F.col("state_id") == "CA", F.col("snap_CA"))
    for state in ("TX", "WI"):
        snap = snap.when(F.col("state_id") == state, F.col(f"snap_{state}"))
    return joined.select(
        "series_id", "item_id", "department_id", "category_id", "store_id", "state_id", "d", "date",
        date_key(date).alias("date_key"), "units_sold", "sell_price",
        revenue_of(units, F.col("sell_price")).alias("revenue"), "wm_yr_wk",
        weekday.alias("weekday"), F.month(date).alias("month"), F.quarter(date).alias("quarter"),
        F.year(date).alias("year"),
        F.col("event_name_1").alias("event_name"), F.col("event_type_1").alias("event_type"),
        "event_name_2", "event_type_2", snap.alias("snap_flag"),
        flag(F.col("event_name_1").isNotNull() | F.col("event_name_2").isNotNull()).alias("event_flag"),
        flag(weekday.isin(0, 6)).alias("weekend_flag"),
        flag(F.dayofmonth(date) == 1).alias("month_start_flag"),
        flag(date == F.last_day(date)).alias("month_end_flag"),
        flag(units == 0).alias("zero_sales_flag"),
    )


def last_date(df: DataFrame, column: str = "date") -> Column:
    """The latest date as a scalar subquery."""
    return df.agg(F.max(column)).scalar()


def trailing(df: DataFrame, origin: Column, days: int) -> DataFrame:
    """Rows of the `days` days that end at `origin`. Where the panel carries its year, the same
    condition on the year lets a year-partitioned table skip the other folders."""
    kept = df.filter((F.col("date") <= origin) & (F.col("date") > F.date_sub(origin, days)))
    if "year" in df.columns:
        kept = kept.filter(F.col("year").between(F.year(F.date_sub(origin, days - 1)), F.year(origin)))
    return kept


def cohort_cutoff(sales: DataFrame, settings: Settings = DEFAULTS) -> Column:
    """Last day before every validation window, so that choosing series sees no held-out demand."""
    window = max(settings.forecast_horizon, settings.simulation_days) * settings.backtest_folds
    return F.date_sub(last_date(sales), window)


def revenue_before_validation(sales: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Revenue per series over the days the cohort is chosen on."""
    recent = trailing(sales, cohort_cutoff(sales, settings), settings.selection_days)
    return recent.groupBy(*SERIES).agg(F.sum("revenue").alias("revenue"))


def in_top_stores(by_series: DataFrame, n: int) -> DataFrame:
    """Series of the n stores with the most revenue."""
    stores = (
        by_series.groupBy("store_id").agg(F.sum("revenue").alias("store_revenue"))
        .orderBy(F.desc("store_revenue"), "store_id").limit(n)
    )
    return by_series.join(F.broadcast(stores), "store_id", "left_semi")  # n rows


def sample_cohort(sales: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The best-selling series of the best-selling stores before the validation windows."""
    by_series = revenue_before_validation(sales, settings)
    return (
        in_top_stores(by_series, settings.sample_stores)
        .orderBy(F.desc("revenue"), *SERIES).limit(settings.sample_series)
        .select(*SERIES)
    )


def full_cohort(demand: DataFrame) -> DataFrame:
    return demand.select(*SERIES).distinct()


def keep_cohort(sales: DataFrame, cohort: DataFrame) -> DataFrame:
    return sales.join(cohort, SERIES, "left_semi")


def first_series(df: DataFrame, n: int) -> DataFrame:
    """The first n series in key order."""
    return df.select(*SERIES).distinct().orderBy(*SERIES).limit(n)


# --- profiles -----------------------------------------------------------------------------------

PROFILE_DIMENSIONS = (
    "category_id", "department_id", "item_id", "store_id", "state_id", "weekday", "month", "event_name", "snap_flag",
)


def sales_by(df: DataFrame, period: Column, name: str = "period") -> DataFrame:
    return df.groupBy(period.alias(name)).agg(
        F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue")
    )


def period_rollups(df: DataFrame) -> DataFrame:
    """Units and revenue by month, by week from Monday, and by day, stacked. Days are summed first;
    the three grains are then formed from one row per day."""
    daily = sales_by(df, F.col("date"), "date")
    grains = F.array(
        F.struct(F.lit("month").alias("grain"), month_start("date").alias("period")),
        F.struct(F.lit("week").alias("grain"), week_start("date").alias("period")),
        F.struct(F.lit("day").alias("grain"), F.col("date").alias("period")),
    )
    return daily.select(F.inline(grains), "units_sold", "revenue").groupBy("grain", "period").agg(
        F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue")
    )


def dimension_profiles(df: DataFrame, dimensions: tuple[str, ...] = PROFILE_DIMENSIONS) -> DataFrame:
    """Units, revenue, mean units per series-day and series-days for every value of every dimension.

    One scan: rows are first summed over all dimensions together, which leaves a table about as long
    as the distinct dimension combinations, and each of those rows then goes to its segments.
    Days without an event form a group of their own.
    """
    combined = df.groupBy(*dimensions).agg(
        F.sum("units_sold").alias("units"), F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("days")
    )
    segments = F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("segment")) for c in dimensions
    ])
    return combined.select(F.inline(segments), "units", "revenue", "days").groupBy("dimension", "segment").agg(
        F.sum("units").alias("units_sold"), F.sum("revenue").alias("revenue"),
        ratio(F.sum("units"), F.sum("days")).alias("mean_series_day_units"),
        F.sum("days").alias("series_days"),
    )


def guarded_correlation(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are present; null when one of them does not vary."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    px, py = F.when(both, F.col(x).cast("double")), F.when(both, F.col(y).cast("double"))
    spread = F.stddev_pop(px) * F.stddev_pop(py)
    # A spread of pure rounding noise is no variation.
    return F.when(spread > 1e-12, F.covar_pop(px, py) / F.nullif(spread, F.lit(0.0)))


def price_demand_correlation(features: DataFrame) -> DataFrame:
    return features.groupBy(*SERIES).agg(
        guarded_correlation("price_change_percentage", "units_sold").alias("price_change_demand_correlation")
    )


def history_summary(sales: DataFrame, origin: Column, settings: Settings = DEFAULTS) -> DataFrame:
    """Demand statistics per series over the days up to `origin`."""
    return trailing(sales, origin, settings.summary_days).groupBy(*SERIES_ATTRIBUTES).agg(
        F.avg("units_sold").alias("average_daily_demand"),
        F.stddev_samp("units_sold").alias("demand_std"),
        F.sum("revenue").alias("revenue"),
        F.sum("units_sold").alias("units_sold"),
        F.avg("zero_sales_flag").alias("zero_demand_share"),
        F.expr("max_by(sell_price, date) FILTER (WHERE sell_price IS NOT NULL)").alias("last_price"),
    )
