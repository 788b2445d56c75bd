"""Past-only features, forecasts and accuracy."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.operators import features, forecast, learned
from shelfline.settings import Settings

COLUMNS = [*(f"lag_{k}" for k in features.LAGS), *(f"rolling_mean_{k}" for k in features.MEAN_DAYS),
           "rolling_std_7", "rolling_28_day_units", "rolling_28_day_revenue", "days_since_last_sale"]


def rows_of(df):
    return [tuple(r) for r in features.add_features(df).orderBy("date").select(*COLUMNS).collect()]


def test_later_values_do_not_reach_earlier_features(one_series):
    units = list(range(1, 81))
    changed = units[:60] + [99999] * 20
    assert rows_of(one_series(units))[:61] == rows_of(one_series(changed))[:61]


def test_rolling_mean_excludes_today(one_series):
    row = features.add_features(one_series(range(1, 81))).orderBy("date").collect()[60]
    assert row["rolling_mean_7"] == sum(range(54, 61)) / 7
    assert row["lag_1"] == 60 and row["days_since_last_sale"] == 1


@pytest.mark.parametrize("units, scale", [([0, 0, 1, 2, 4], 2.5), ([1, 1, 1], None), ([0, 0, 0], None), ([5], None)])
def test_error_scale(one_series, units, scale):
    assert features.error_scale(one_series(units)).first()["scale"] == scale


def test_seasonal_naive_cycles_short_history(one_series):
    df = one_series(range(1, 8))
    origins = forecast.origins_of(df, [forecast.Fold(1, dt.date(2020, 1, 7), "test")])
    rows = forecast.apply_baselines(forecast.forecast_days(origins, 10), ["seasonal_7", "seasonal_28", "naive", "moving_average"])
    by_model = {m: [r["forecast_units"] for r in rows.filter(F.col("model") == m).orderBy("horizon").collect()]
                for m in ("seasonal_7", "seasonal_28", "naive", "moving_average")}
    assert by_model["seasonal_7"] == by_model["seasonal_28"] == [1, 2, 3, 4, 5, 6, 7, 1, 2, 3]
    assert by_model["naive"] == [7.0] * 10 and by_model["moving_average"] == [4.0] * 10


def test_wape_is_null_without_demand(spark):
    df = spark.createDataFrame([(1.0, 0.0, None), (1.0, 0.0, None)], "forecast_units double, actual_units double, scale double")
    row = df.agg(*forecast.accuracy()).first()
    assert row["wape"] is None and row["mape"] is None and row["rmsse"] is None and row["mae"] == 1.0


def test_held_out_values_do_not_reach_the_forecast(data):
    fold = data.folds[-1]
    later = data.sales.withColumn("units_sold", F.when(F.col("date") > F.lit(fold.origin), 999).otherwise(F.col("units_sold")))
    a, b = (
        forecast.apply_baselines(forecast.forecast_days(forecast.origins_of(s, [fold]), 28)).agg(
            F.sum("forecast_units"), F.sum("scale"), F.count(F.lit(1))).first()
        for s in (data.sales, later)
    )
    assert tuple(a) == tuple(b)


def test_folds_end_with_the_history():
    folds = forecast.rolling_folds(dt.date(2020, 12, 31), Settings())
    assert [f.role for f in folds] == ["calibration", "selection", "test"]
    assert folds[-1].origin + dt.timedelta(days=28) == dt.date(2020, 12, 31)


def test_production_forecast_shape(data):
    bad = data.future.filter(
        "datediff(date, origin) <> horizon OR lower_95 > lower_80 OR lower_80 > forecast_units OR forecast_units > upper_80 OR upper_80 > upper_95")
    assert bad.count() == 0
    assert data.future.groupBy("item_id", "store_id").count().filter("count <> 28").count() == 0


def test_calendar_has_to_cover_the_horizon(data):
    forecast.require_calendar(data.calendar, data.end, 28)
    with pytest.raises(ValueError, match="covers 28 of 29"):
        forecast.require_calendar(data.calendar, data.end, 29)


def test_interval_falls_back_to_pooled_residuals(spark):
    preds = spark.createDataFrame([(1, 5.0), (2, 5.0)], "horizon int, forecast_units double")
    residuals = spark.createDataFrame([(1, 4.0, 5.0), (1, 8.0, 5.0)], "horizon int, actual_units double, forecast_units double")
    rows = {r["horizon"]: r for r in forecast.add_intervals(preds, residuals).collect()}
    assert rows[1]["upper_80"] == rows[2]["upper_80"] == pytest.approx(5 + 3 - 0.4)
    assert rows[2]["lower_95"] == pytest.approx(5 - 1 + 0.1)


def test_training_sample_is_exact_and_stable(data):
    keys = data.sales.select("item_id", "store_id", "date")
    a = features.training_sample(keys, 1000, 42)
    b = features.training_sample(keys.repartition(7, "date"), 1000, 42)
    assert a.count() == 1000 and a.exceptAll(b).count() == 0


def test_learned_forecast_ignores_the_future_and_is_not_negative(data):
    fold, few = data.folds[-1], Settings(boosting_rounds=3)
    model = learned.train_model(data.sales, fold.origin, few)
    later = data.sales.withColumn("units_sold", F.when(F.col("date") > F.lit(fold.origin), 999).otherwise(F.col("units_sold")))
    a, b = (learned.forecast_recursively(model, s, data.calendar, fold.origin, 5) for s in (data.sales, later))
    assert a.exceptAll(b).count() == 0
    assert a.filter("forecast_units < 0").count() == 0
    assert a.groupBy("item_id", "store_id").count().filter("count <> 5").count() == 0


def test_unseen_level_gets_the_overall_mean(spark, data):
    model_levels = spark.createDataFrame([("item_id", "known", 3.0)], "column string, level string, code double")
    df = spark.createDataFrame([("known",), ("other",), (None,)], "item_id string")
    codes = [r["item_id_code"] for r in learned.encode(df, model_levels, 1.5, ["item_id"]).orderBy(F.asc_nulls_last("item_id")).collect()]
    assert codes == [3.0, 1.5, 1.5]
