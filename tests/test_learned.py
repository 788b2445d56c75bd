"""The learned demand model: features of recent days, codes, missing numbers and its place in the backtest."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfline.operators import features, forecast, learned
from shelfline.settings import Settings

KEY = ["item_id", "store_id", "date"]


def test_recent_features_equal_those_of_the_whole_history(data):
    origin, start = data.test_origin, data.test_origin - dt.timedelta(days=40)
    names = [*KEY, *features.lags(), *features.rolling_means(), "price_change_percentage", "days_since_last_sale"]
    rounded = [F.round(c, 9).alias(c) if "mean" in c or "change" in c else F.col(c) for c in names]
    whole = features.add_features(data.sales).filter((F.col("date") > F.lit(start)) & (F.col("date") <= F.lit(origin))).select(*rounded)
    recent = features.recent_features(data.sales, start, origin).select(*rounded)
    assert recent.count() == whole.count() > 0
    assert recent.exceptAll(whole).isEmpty() and whole.exceptAll(recent).isEmpty()


def test_every_row_of_the_training_year_is_used(data):
    rows = learned.training_rows(data.sales, data.test_origin, data.settings)
    start = data.test_origin - dt.timedelta(days=data.settings.training_days)
    assert rows.count() == data.sales.filter((F.col("date") > F.lit(start)) & (F.col("date") <= F.lit(data.test_origin))).count()


def test_codes_are_shrunk_and_constant_in_a_level(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", 8.0), ("b", 5.0)]
    train = spark.createDataFrame(rows, "item_id string, units_sold double").withColumns(
        {c: F.lit("x") for c in learned.CATEGORICAL if c != "item_id"})
    levels = learned.shrunk(learned.fit_levels(train), 4.25, 20.0)
    codes = {(r["item_id"], r["item_id_code"]) for r in learned.encode(train, levels, 4.25).collect()}
    assert codes == {("a", pytest.approx((12 + 85) / 23)), ("b", pytest.approx((5 + 85) / 21))}


def test_training_does_not_read_its_own_outcome(spark, data):
    """Demand that is drawn anew for every row can't be learned: the deviance stays near that of the mean."""
    drawn = data.sales.withColumn("units_sold", F.pmod(F.xxhash64("item_id", "store_id", "date"), F.lit(4)).cast("long"))
    model = learned.train_model(drawn, data.test_origin, Settings(count_rounds=6), "boosted")
    assert model.deviances[-1] > 0.9 * model.deviances[0]


def test_a_regression_reads_means_and_marks_for_missing_numbers(spark):
    row = spark.range(1).withColumns({c: F.lit(None).cast("double") for c in learned.NUMERIC} | {f"{c}_code": F.lit(1.0) for c in learned.CATEGORICAL})
    means = {c: float(i) for i, c in enumerate(learned.NUMERIC)}
    vector = learned.assemble(row, means).first()["vector"].toArray().tolist()
    assert vector == [*means.values(), *[1.0] * len(learned.GAPS), *[1.0] * len(learned.CATEGORICAL)]
    plain = learned.assemble(row).first()["vector"].toArray().tolist()
    assert plain == [learned.FILL] * len(learned.NUMERIC) + [1.0] * len(learned.CATEGORICAL)


def test_the_champion_is_the_least_wape_of_all_models(data):
    few = Settings(boosting_rounds=2)
    baselines = data.backtest
    own = learned.backtest_rows(baselines, data.sales, data.calendar, data.folds[1:2], 28, few)
    rows = baselines.unionByName(own.select(baselines.columns))
    wape = {r["model"]: r["w"] for r in rows.filter("split_role = 'selection'").groupBy("model").agg(
        (F.sum("absolute_error") / F.sum("actual_units")).alias("w")).collect()}
    assert len(wape) == 5
    assert forecast.champion(forecast.model_metrics(rows)).first()["model"] == min(sorted(wape), key=wape.get)
    assert own.filter("forecast_units < 0 OR forecast_units IS NULL").isEmpty()


def test_forecasts_follow_day_by_day(data):
    """The fold over the days against a loop in plain Python that appends each forecast to the series."""
    few = Settings(boosting_rounds=3, count_rounds=2)
    origin = data.test_origin
    for learner in learned.LEARNERS:
        model = learned.train_model(data.sales, origin, few, learner)
        whole = learned.forecast_recursively(model, data.sales, data.calendar, origin, 6)
        rows = {(r["item_id"], r["store_id"], r["horizon"]): r["forecast_units"] for r in whole.collect()}
        state = learned.encode(learned.initial_state(data.sales, origin), model.levels, model.overall, learned._STATIC)
        days = learned.known_days(data.calendar, origin, 6, model)
        for step in range(1, 7):
            dated = state.withColumn("date", F.date_add(F.lit(origin), step)).join(F.broadcast(days), "date").withColumns(learned.past_features())
            scored = learned.assemble(dated, model.means).withColumn(
                "next", F.least(F.greatest(model.model.predict(vector_to_array("vector")), F.lit(0.0)), F.lit(model.most)))
            found = scored.select("item_id", "store_id", "next").collect()
            assert {rows[r["item_id"], r["store_id"], step] for r in found} and all(
                abs(rows[r["item_id"], r["store_id"], step] - r["next"]) < 1e-9 for r in found)
            if step == 2:
                break
            state = scored.select(*[{
                "y": learned._last(F.concat("y", F.array("next")), learned.KEPT_DAYS).alias("y"),
                "gap": F.when(F.col("next") > 0, F.lit(1.0)).otherwise(F.col("gap") + 1).alias("gap")}.get(c, F.col(c)) for c in state.columns])


def test_a_forecast_is_one_projection(data):
    model = learned.train_model(data.sales, data.test_origin, Settings(boosting_rounds=2), "trees")
    plan = learned.forecast_recursively(model, data.sales, data.calendar, data.test_origin, 28)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and plan.count("Join") == 5  # the series' state, and a code for each category


def test_a_repeated_outcome_stops_the_backtest(data):
    day = data.sales.filter(F.col("date") > F.lit(data.test_origin)).limit(1)
    with pytest.raises(PySparkException, match="repeated key"):
        forecast.backtest(data.sales.unionByName(day), data.folds[-1:], 28).count()


def test_series_are_spread_before_they_are_folded(data):
    """Few short rows carry the work of many days: they are dealt over all tasks, whatever their bytes."""
    model = learned.Learned(learned.Linear([0.0] * 25, 0.0, True), data.spark.createDataFrame([], "column string, level string, code double"), 1.0)
    plan = learned.forecast_recursively(model, data.sales, data.calendar, data.test_origin, 2)._jdf.queryExecution().optimizedPlan().toString()
    tasks = data.spark.conf.get("spark.sql.shuffle.partitions")
    assert f"RepartitionByExpression [item_id" in plan and f"], {tasks}" in plan
