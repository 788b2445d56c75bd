"""Baseline forecasts, rolling-origin backtest, accuracy and empirical intervals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import date_key, ratio
from shelfline.operators.features import error_scale_parts
from shelfline.operators.ordered import exact_quantiles
from shelfline.operators.orders import in_segments
from shelfline.operators.panel import SERIES, SERIES_ATTRIBUTES
from shelfline.operators.quality import QualityError, many_to_one
from shelfline.settings import DEFAULTS, Settings

BASELINES = ("naive", "seasonal_7", "seasonal_28", "moving_average")
RECENT_DAYS = 28
LEVELS = (80, 95)
SEGMENTS = ("state_id", "store_id", "category_id", "department_id", "volume_segment", "abc_xyz")


@dataclass(frozen=True)
class Fold:
    number: int
    origin: dt.date
    role: str


def rolling_folds(end: dt.date, settings: Settings = DEFAULTS) -> list[Fold]:
    """Consecutive validation windows that end with the history: the last is the test, the one
    before it selects the model, earlier ones calibrate intervals."""
    n, days = settings.backtest_folds, settings.fold_days
    roles = {n: "test", n - 1: "selection"}
    return [
        Fold(f, end - dt.timedelta(days=(n - f + 1) * days), roles.get(f, "calibration")) for f in range(1, n + 1)
    ]


def origins_of(sales: DataFrame, folds: Sequence[Fold]) -> DataFrame:
    """One row per series and fold: the units of the last days up to the origin, and the error scale.

    The scale's window has already placed a series on one task, so the aggregation adds no shuffle.
    A series contributes one bounded array per fold.
    """
    last = max(f.origin for f in folds)
    known = error_scale_parts(sales.filter(F.col("date") <= F.lit(last)))
    date = F.col("date")
    columns = []
    for f in folds:
        origin = F.lit(f.origin)
        recent = F.when((date <= origin) & (date > F.date_sub(origin, RECENT_DAYS)), F.struct("date", "units_sold"))
        mean_step = F.avg(F.when(date <= origin, F.col("squared_step")))
        columns.append(F.struct(
            F.lit(f.number).alias("fold"), origin.alias("origin"), F.lit(f.role).alias("split_role"),
            F.array_sort(F.collect_list(recent))["units_sold"].alias("y"),
            F.when(mean_step > 0, mean_step).alias("scale"),
        ))
    grouped = known.groupBy(*SERIES_ATTRIBUTES).agg(F.array(*columns).alias("folds"))
    return grouped.select(*SERIES_ATTRIBUTES, F.inline("folds"))


def baseline(name: str, y: Column, horizon: Column) -> Column:
    """Forecast `horizon` days after the last value of the array `y`."""
    if name == "naive":
        value = F.element_at(y, -1)
    elif name == "moving_average":
        value = F.aggregate(y, F.lit(0.0), lambda total, x: total + x) / F.size(y)
    elif name.startswith("seasonal_"):
        cycle = F.least(F.lit(int(name.split("_")[1])), F.size(y))
        value = F.get(y, F.size(y) - cycle + (horizon - 1) % cycle)
    else:
        raise ValueError(f"no baseline named {name}")
    return value.cast("double")


def forecast_days(origins: DataFrame, horizon: int) -> DataFrame:
    return origins.filter(F.size("y") > 0).withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(
        "date", F.date_add("origin", F.col("horizon"))
    ).withColumn("date_key", date_key("date"))


def apply_baselines(days: DataFrame, models: Sequence[str] = BASELINES) -> DataFrame:
    """One row per model for every forecast day."""
    forecasts = F.array(*[
        F.struct(F.lit(m).alias("model"), baseline(m, F.col("y"), F.col("horizon")).alias("forecast_units")) for m in models
    ])
    return days.select(*[c for c in days.columns if c != "y"], F.inline(forecasts))


def require_calendar(calendar: DataFrame, origin: dt.date, horizon: int) -> None:
    """Every date to forecast has to be in the calendar."""
    covered = calendar.filter(
        (F.col("date") > F.lit(origin)) & (F.col("date") <= F.date_add(F.lit(origin), horizon))
    ).select("date").distinct().count()
    if covered != horizon:
        raise QualityError(f"the calendar covers {covered} of {horizon} days after {origin}")


def with_errors(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("error", F.col("forecast_units") - F.col("actual_units")).withColumn(
        "absolute_error", F.abs("error")
    )


def actual_units(sales: DataFrame, after: dt.date) -> DataFrame:
    return sales.filter(F.col("date") > F.lit(after)).select(*SERIES, "date", F.col("units_sold").alias("actual_units"))


def join_actuals(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Forecasts of days whose outcome is known; an outcome has to be unique."""
    return with_errors(many_to_one(predictions, actuals, [*SERIES, "date"], "actual units"))


def backtest(sales: DataFrame, folds: Sequence[Fold], horizon: int, models: Sequence[str] = BASELINES) -> DataFrame:
    """Forecasts of every model in every fold next to the outcome, which has to be unique. Outcomes join before the rows multiply
    by model."""
    days = forecast_days(origins_of(sales, folds), horizon)
    actuals = actual_units(sales, min(f.origin for f in folds))
    return with_errors(apply_baselines(many_to_one(days, actuals, [*SERIES, "date"], "actual units"), models))


# --- accuracy -----------------------------------------------------------------------------------

def accuracy() -> list[Column]:
    """Accuracy aggregates over rows of forecast_units, actual_units and scale."""
    error = F.col("forecast_units") - F.col("actual_units")
    actual, scale = F.col("actual_units"), F.col("scale")
    return [
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        ratio(F.sum(F.abs(error)), F.sum(actual)).alias("wape"),
        F.avg(F.when(actual != 0, F.abs(error) / F.nullif(actual.cast("double"), F.lit(0.0)))).alias("mape"),
        ratio(F.sum(error), F.sum(actual)).alias("bias"),
        F.sqrt(F.avg(F.when(scale > 0, error * error / F.nullif(scale, F.lit(0.0))))).alias("rmsse"),
    ]


def model_metrics(backtest_rows: DataFrame) -> DataFrame:
    return backtest_rows.groupBy("model", "fold", "split_role", "origin").agg(*accuracy()).withColumn(
        "forecast_level", F.lit("item_store")
    )


def portfolio_metrics(backtest_rows: DataFrame) -> DataFrame:
    """Accuracy of the forecast total against the total of all series, day by day."""
    totals = backtest_rows.groupBy("model", "fold", "split_role", "origin", "date").agg(
        F.sum("forecast_units").alias("forecast_units"), F.sum("actual_units").alias("actual_units"),
        F.lit(None).cast("double").alias("scale"),
    )
    return totals.groupBy("model", "fold", "split_role", "origin").agg(*accuracy()).withColumn(
        "forecast_level", F.lit("selected_portfolio_total")
    )


def champion(metrics: DataFrame) -> DataFrame:
    """One row: the model with the smallest WAPE, then MAE, then name, in the selection fold."""
    return metrics.filter("split_role = 'selection' AND forecast_level = 'item_store'").orderBy(
        F.asc_nulls_last("wape"), F.asc_nulls_last("mae"), "model"
    ).limit(1).select("model")


def of_champion(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(chosen), "model", "left_semi")  # one row


def segment_metrics(test: DataFrame, segments: DataFrame) -> DataFrame:
    """Accuracy for every value of six segment columns, the labels frozen at the test origin."""
    labelled = test.join(segments.select(*SERIES, "abc_xyz", "volume_segment"), SERIES)
    return in_segments(labelled, SEGMENTS).groupBy(
        F.col("dimension").alias("segment_type"), "segment", "model"
    ).agg(*accuracy())


# --- intervals ----------------------------------------------------------------------------------

def _tails() -> dict[str, float]:
    tails = {}
    for level in LEVELS:
        alpha = (1 - level / 100) / 2
        tails[f"lower_{level}"], tails[f"upper_{level}"] = alpha, 1 - alpha
    return tails


def add_intervals(predictions: DataFrame, residual_rows: DataFrame) -> DataFrame:
    """Bounds from the quantiles of past residuals of the same horizon, or of all horizons where
    that one has none; never below zero and always around the forecast."""
    tails = _tails()
    residuals = residual_rows.select("horizon", (F.col("actual_units") - F.col("forecast_units")).alias("residual"))
    # One row per horizon day.
    by_horizon = exact_quantiles(residuals, ["horizon"], "residual", {f"_{b}": p for b, p in tails.items()})
    pooled = exact_quantiles(residuals, [], "residual", tails).select(F.struct(*tails)).scalar()
    joined = predictions.join(F.broadcast(by_horizon), "horizon", "left")
    point = F.col("forecast_units")
    bounds = {}
    for name in tails:
        bound = F.greatest(F.lit(0.0), point + F.coalesce(F.col(f"_{name}"), pooled[name]))
        bounds[name] = F.least(bound, point) if name.startswith("lower") else F.greatest(bound, point)
    return joined.withColumns(bounds).drop(*[f"_{b}" for b in tails])


def with_coverage(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        f"covered_{level}": F.col("actual_units").between(F.col(f"lower_{level}"), F.col(f"upper_{level}"))
        for level in LEVELS
    })


def coverage_rates(test: DataFrame) -> DataFrame:
    return test.agg(*[F.avg(F.col(f"covered_{level}").cast("int")).alias(f"coverage_{level}") for level in LEVELS])


def selected_test(backtest_rows: DataFrame, chosen: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The champion's test forecasts, with intervals from the calibration folds alone."""
    own = of_champion(backtest_rows, chosen)
    calibration = own.filter(F.col("fold") < settings.backtest_folds - 1)
    return with_coverage(add_intervals(own.filter(F.col("fold") == settings.backtest_folds), calibration))


def pretest_errors(backtest_rows: DataFrame, chosen: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return of_champion(backtest_rows, chosen).filter(F.col("fold") < settings.backtest_folds)


def production_forecast(
    sales: DataFrame, origin: dt.date, chosen: DataFrame, errors: DataFrame, horizon: int,
    models: Sequence[str] = BASELINES,
) -> DataFrame:
    """The champion's forecast after the last day, with intervals from every pre-test fold."""
    days = forecast_days(origins_of(sales, [Fold(0, origin, "production")]), horizon)
    future = of_champion(apply_baselines(days, models), chosen).drop("fold", "split_role")
    return add_intervals(future, errors)


def daily_test_totals(test: DataFrame) -> DataFrame:
    """Outcome, forecast and bounds summed by day, for display."""
    return test.groupBy("date").agg(*[
        F.sum(c).alias(c) for c in ("actual_units", "forecast_units", "lower_80", "upper_80", "lower_95", "upper_95")
    ])
