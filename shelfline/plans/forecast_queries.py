"""Queries over forecasts and the backtest."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions.columns import ratio
from shelfline.operators import dimensions, forecast
from shelfline.plans import marts, reports
from shelfline.plans.data import Data
from shelfline.plans.oracle import ACCURACY
from shelfline.plans.query import Query

_METRICS = "mae rmse wape mape bias rmsse"
_BOUNDS = "lower_80 upper_80 lower_95 upper_95"
_ROWS = "item_id, store_id, origin, date, horizon, model, fold, split_role, forecast_units, actual_units, error, absolute_error"


def _folds(d: Data):
    """The validation windows, joined to the panel days they cover."""
    table = d.spark.createDataFrame([(f.number, f.origin, f.role) for f in d.folds], "fold int, origin date, split_role string")
    days = d.sales.filter(F.col("date") > F.lit(d.folds[0].origin)).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
    inside = (F.col("date") > F.col("origin")) & (F.col("date") <= F.date_add("origin", d.settings.fold_days))
    return days.join(F.broadcast(table), inside).groupBy("fold", "origin", "split_role").agg(  # one row per fold
        F.min("date").alias("validation_start"), F.max("date").alias("validation_end"), F.sum("rows").alias("series_days")
    )


def _baseline(*models: str):
    return lambda d: d.backtest.filter(F.col("model").isin(*models)).select(
        "item_id", "store_id", "origin", "date", "model", "forecast_units"
    )


def _baseline_sql(*models: str) -> str:
    names = ", ".join(f"'{m}'" for m in models)
    return f"SELECT item_id, store_id, origin, date, model, forecast_units FROM backtest WHERE model IN ({names})"


def _calendar_cover(d: Data):
    future = d.calendar.filter(F.col("date") > d.today)
    return future.agg(F.count(F.lit(1)).alias("future_days"), F.min("date").alias("first"), F.max("date").alias("last"))


QUERIES = [
    Query("i14_wape_by_store", lambda d: reports.wape_by(d.backtest.filter("split_role = 'test'"), "store_id", "model"),
          "SELECT store_id, model, sum(absolute_error) / nullif(sum(actual_units), 0) AS wape FROM backtest WHERE split_role = 'test' GROUP BY 1, 2",
          "wape"),
    Query("i15_wape_by_category", lambda d: reports.wape_by_category(d.backtest.filter("split_role = 'test'"), d.products),
          """SELECT p.category_id, b.model, sum(b.absolute_error) / nullif(sum(b.actual_units), 0) AS wape
             FROM backtest AS b JOIN dim_product AS p ON p.item_id = b.item_id WHERE b.split_role = 'test' GROUP BY 1, 2""", "wape"),
    Query("b01_rolling_folds", _folds,
          """SELECT fold, origin, split_role, min(date) AS validation_start, max(date) AS validation_end, count(*) AS series_days
             FROM folds JOIN sales ON date > origin AND date <= origin + 28 GROUP BY 1, 2, 3"""),
    Query("b02_naive", _baseline("naive"), _baseline_sql("naive"), "forecast_units"),
    Query("b03_moving_average", _baseline("moving_average"), _baseline_sql("moving_average"), "forecast_units"),
    Query("b04_seasonal_naive", _baseline("seasonal_7", "seasonal_28"), _baseline_sql("seasonal_7", "seasonal_28"), "forecast_units"),
    Query("b09_calendar_cover", _calendar_cover,
          "SELECT count(*) AS future_days, min(date) AS first, max(date) AS last FROM calendar WHERE date > (SELECT hi FROM bounds)"),
    Query("b10_backtest", lambda d: d.backtest.select(*_ROWS.split(", ")), f"SELECT {_ROWS} FROM backtest", "forecast_units error absolute_error"),
    Query("b11_model_metrics", lambda d: forecast.model_metrics(d.backtest),
          f"SELECT model, fold, split_role, origin, {ACCURACY}, 'item_store' AS forecast_level FROM backtest GROUP BY 1, 2, 3, 4", _METRICS),
    Query("b12_portfolio_metrics", lambda d: forecast.portfolio_metrics(d.backtest),
          f"""SELECT model, fold, split_role, origin, {ACCURACY}, 'selected_portfolio_total' AS forecast_level
              FROM (SELECT model, fold, split_role, origin, date, sum(forecast_units) AS forecast_units, sum(actual_units) AS actual_units, NULL::DOUBLE AS scale
                    FROM backtest GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3, 4""", _METRICS),
    Query("b13_champion", lambda d: d.champion, "SELECT model FROM champion"),
    Query("b14_test_intervals", lambda d: d.test.select("item_id", "store_id", "date", "model", "forecast_units", *_BOUNDS.split()),
          "SELECT item_id, store_id, date, model, forecast_units, lower_80, upper_80, lower_95, upper_95 FROM test", f"forecast_units {_BOUNDS}"),
    Query("b15_coverage", lambda d: forecast.coverage_rates(d.test),
          "SELECT avg(covered_80::INTEGER) AS coverage_80, avg(covered_95::INTEGER) AS coverage_95 FROM test", "coverage_80 coverage_95"),
    Query("b16_segment_metrics", lambda d: forecast.segment_metrics(d.test, d.pretest_segments),
          f"SELECT segment_type, segment, model, {ACCURACY} FROM (" + " UNION ALL ".join(
              f"SELECT '{c}' AS segment_type, {'g' if c in ('abc_xyz', 'volume_segment') else 't'}.{c} AS segment, t.model, t.forecast_units, t.actual_units, t.scale "
              "FROM test AS t JOIN segments_pretest AS g ON g.item_id = t.item_id AND g.store_id = t.store_id" for c in forecast.SEGMENTS)
          + ") GROUP BY 1, 2, 3", _METRICS),
    Query("b17_error_scales",
          lambda d: d.backtest.filter("model = 'naive' AND horizon = 1").select("item_id", "store_id", "fold", "scale"),
          "SELECT item_id, store_id, fold, scale FROM scales WHERE fold > 0", "scale"),
    Query("b18_production_forecast",
          lambda d: d.future.select("item_id", "store_id", "origin", "date", "date_key", "horizon", "model", "forecast_units", *_BOUNDS.split()),
          "SELECT item_id, store_id, origin, date, date_key, horizon, model, forecast_units, lower_80, upper_80, lower_95, upper_95 FROM future",
          f"forecast_units {_BOUNDS}"),
    Query("a19_daily_test_totals", lambda d: forecast.daily_test_totals(d.test),
          "SELECT date, CAST(sum(actual_units) AS BIGINT) AS actual_units, sum(forecast_units) AS forecast_units, sum(lower_80) AS lower_80, sum(upper_80) AS upper_80, sum(lower_95) AS lower_95, sum(upper_95) AS upper_95 FROM test GROUP BY 1",
          f"forecast_units {_BOUNDS}"),
    Query("d09_mart_forecast_accuracy", lambda d: marts.forecast_accuracy(d.backtest),
          """SELECT model, split_role, store_id, sum(absolute_error) / nullif(sum(actual_units), 0) AS wape, sum(error) / nullif(sum(actual_units), 0) AS bias
             FROM backtest GROUP BY 1, 2, 3""", "wape bias"),
    Query("i25_executive_kpis", lambda d: marts.executive_kpis(d.sales, d.future, d.delivery, d.lines),
          """SELECT 'panel' AS domain, 'historical_revenue' AS metric, sum(revenue) AS value FROM sales
             UNION ALL SELECT 'panel', 'forecast_units', sum(forecast_units) FROM future
             UNION ALL SELECT 'orders', 'late_delivery_rate', avg(late_order) FROM delivery WHERE delivery_eligible
             UNION ALL SELECT 'orders', 'profit', sum(profit) FROM lines WHERE NOT invalid_sales_flag""", "value"),
    Query("k03_forecast_measures",
          lambda d: d.test.groupBy("store_id").agg(
              F.sum("forecast_units").alias("forecast_units"), F.sum("actual_units").alias("actual_units"),
              F.sum("error").alias("forecast_error"), F.sum("absolute_error").alias("absolute_forecast_error"),
              ratio(F.sum("absolute_error"), F.sum("actual_units")).alias("forecast_wape"),
              ratio(F.sum("error"), F.sum("actual_units")).alias("forecast_bias")),
          """SELECT store_id, sum(forecast_units) AS forecast_units, CAST(sum(actual_units) AS BIGINT) AS actual_units, sum(error) AS forecast_error,
                    sum(absolute_error) AS absolute_forecast_error, sum(absolute_error) / nullif(sum(actual_units), 0) AS forecast_wape,
                    sum(error) / nullif(sum(actual_units), 0) AS forecast_bias FROM test GROUP BY 1""",
          "forecast_units forecast_error absolute_forecast_error forecast_wape forecast_bias"),
]
