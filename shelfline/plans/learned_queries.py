"""Queries over learned models. Their coefficients have no SQL equivalent, so most have no oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import forecast, learned, risk
from shelfline.operators.features import CATEGORICAL, LAGS, MEAN_DAYS, SPREAD_DAYS
from shelfline.plans.data import Data
from shelfline.plans.query import Query

_PAST = [*(f"lag_{k}" for k in LAGS), *(f"rolling_mean_{k}" for k in MEAN_DAYS), *(f"rolling_std_{k}" for k in SPREAD_DAYS)]


def _past_features(d: Data):
    """The feature row of the first day after the test origin, from the series state alone."""
    state = learned.initial_state(d.sales, d.test_origin).withColumn("date", F.date_add(F.lit(d.test_origin), 1))
    dated = state.join(F.broadcast(d.calendar), "date")  # one row per calendar day
    return dated.withColumns(learned.past_features()).select(
        "item_id", "store_id", *_PAST, "days_since_last_sale", "snap_flag", "weekday", "week")


def _risk_metrics(d: Data):
    return risk.risk_metrics(d.risk[0])


RATE_MODELS = {"mode_rate": ("shipping_mode",), "mode_region_rate": ("shipping_mode", "region")}

_SPLIT = """(SELECT order_date FROM (SELECT order_date, row_number() OVER (ORDER BY order_date) - 1 AS place, count(*) OVER () AS n
                                    FROM (SELECT DISTINCT order_date FROM delivery WHERE delivery_eligible))
            WHERE place = CAST(floor(0.8::DOUBLE * n) AS BIGINT))"""


def _counts(d: Data, learner: str):
    rows = d.learned_forecast(learner)
    return rows.groupBy("origin", "horizon").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("item_id", "store_id").alias("series"),
        F.count_if(F.col("forecast_units").isNull() | F.isnan("forecast_units")).alias("unknown"),
        F.count_if(F.col("forecast_units") < 0).alias("negative"), (F.sum("forecast_units") > 0).alias("some_demand"))


_COUNTS = """SELECT (SELECT origin FROM folds WHERE fold = 3) AS origin, horizon, series AS rows, series, 0 AS unknown, 0 AS negative, true AS some_demand
             FROM (SELECT CAST(unnest(range(1, 29)) AS INTEGER) AS horizon),
                  (SELECT count(DISTINCT (item_id, store_id)) AS series FROM sales WHERE date <= (SELECT origin FROM folds WHERE fold = 3))"""


def _rounds(d: Data):
    """One row per boosting round: the deviance before and after it."""
    found = d.boosted.deviances
    return d.spark.createDataFrame(
        [(i + 1, before, after) for i, (before, after) in enumerate(zip(found, found[1:]))], "round int, before double, after double")


QUERIES = [
    Query("b05_boosted_forecast", lambda d: d.learned_forecast("boosted")),
    Query("b05_boosted_counts", lambda d: _counts(d, "boosted"), _COUNTS),
    Query("b08_tree_counts", lambda d: _counts(d, "trees"), _COUNTS),
    Query("b05_deviance_falls", lambda d: _rounds(d).select("round", (F.col("after") < F.col("before")).alias("falls"), (F.col("after") > 0).alias("positive")),
          "SELECT CAST(unnest(range(1, 21)) AS INTEGER) AS round, true AS falls, true AS positive"),
    Query("o08_rate_areas", lambda d: risk.areas(risk.rate_scores(d.delivery, RATE_MODELS)),
          " UNION ALL ".join(f"""
             SELECT '{name}' AS model, sum(timely * (late_upto - late / 2.0)) / (max(all_late) * max(all_timely)) AS roc_auc,
                    sum(late * late_upto / (late_upto + timely_upto)::DOUBLE) / max(all_late) AS pr_auc
             FROM (SELECT *, sum(late) OVER upto AS late_upto, sum(timely) OVER upto AS timely_upto, sum(late) OVER () AS all_late, sum(timely) OVER () AS all_timely
                   FROM (SELECT coalesce(rate, (SELECT avg(late_order) FROM delivery WHERE delivery_eligible AND order_date < {_SPLIT})) AS score,
                                count(*) FILTER (late_order = 1) AS late, count(*) FILTER (late_order = 0) AS timely
                         FROM delivery LEFT JOIN (SELECT {', '.join(c)}, avg(late_order) AS rate FROM delivery
                                                  WHERE delivery_eligible AND order_date < {_SPLIT} GROUP BY {', '.join(c)}) USING ({', '.join(c)})
                         WHERE delivery_eligible AND order_date >= {_SPLIT} GROUP BY 1)
                   WINDOW upto AS (ORDER BY score DESC))""" for name, c in RATE_MODELS.items()), "roc_auc pr_auc"),
    Query("b05_poisson_forecast", lambda d: d.learned_forecast("poisson")),
    Query("b08_tree_forecast", lambda d: d.learned_forecast("trees")),
    Query("b10_learned_folds", lambda d: d.learned_backtest.groupBy("fold", "split_role", "origin").agg(
              F.countDistinct("item_id", "store_id").alias("series"), F.countDistinct("date").alias("days"), F.count(F.lit(1)).alias("rows"),
              F.count_if(F.col("forecast_units").isNull()).alias("unknown"), F.count_if(F.col("forecast_units") < 0).alias("negative"),
              F.count_if(~F.datediff("date", "origin").between(1, d.settings.fold_days)).alias("outside"), F.sum("actual_units").alias("actual_units")),
          """SELECT fold, split_role, origin, count(DISTINCT (item_id, store_id)) AS series, count(DISTINCT date) AS days, count(*) AS rows,
                    0 AS unknown, 0 AS negative, 0 AS outside, CAST(sum(actual_units) AS BIGINT) AS actual_units
             FROM backtest WHERE model = 'naive' GROUP BY 1, 2, 3"""),
    Query("b11_all_model_metrics", lambda d: forecast.model_metrics(d.contest)),
    Query("b13_champion_of_all", lambda d: forecast.champion(forecast.model_metrics(d.contest))),
    Query("b06_category_levels", lambda d: learned.fit_levels(d.training).drop("rows"),
          " UNION ALL ".join(
              f"SELECT '{c}' AS column, coalesce({c}, 'Unknown') AS level, avg(units_sold) AS code FROM training GROUP BY 2" for c in CATEGORICAL),
          "code"),
    Query("b07_past_features", _past_features,
          f"""SELECT item_id, store_id, {', '.join(_PAST)}, CAST(days_since_last_sale AS DOUBLE) AS days_since_last_sale, snap_flag, weekday, week
              FROM features WHERE date = (SELECT origin FROM folds WHERE fold = 3) + 1""", " ".join(_PAST)),
    Query("o07_risk_metrics", _risk_metrics),
    Query("o07_test_outcomes", lambda d: _risk_metrics(d).select(
              "model", (F.col("tn") + F.col("fp")).alias("on_time"), (F.col("fn") + F.col("tp")).alias("late")),
          """SELECT model, count(*) FILTER (late_order = 0) AS on_time, count(*) FILTER (late_order = 1) AS late
             FROM (SELECT *, unnest(['logistic_regression', 'decision_tree', 'random_forest', 'boosted_trees']) AS model FROM delivery
                   WHERE delivery_eligible AND order_date >= (
                     SELECT order_date FROM (SELECT order_date, row_number() OVER (ORDER BY order_date) - 1 AS place, count(*) OVER () AS n
                                             FROM (SELECT DISTINCT order_date FROM delivery WHERE delivery_eligible))
                     WHERE place = CAST(floor(0.8::DOUBLE * n) AS BIGINT))) GROUP BY 1"""),
    Query("o09_feature_importance", lambda d: d.risk[1]),
]
