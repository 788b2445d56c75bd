"""Global learned demand model over all series, and its recursive forecast."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import date_key, sunday_zero_weekday
from shelfline.operators.boosting import DEPTH, Linear, Trees, boost_counts, count_regression, of_boosted
from shelfline.operators.features import CATEGORICAL, LAGS, MEAN_DAYS, NUMERIC, SPREAD_DAYS, recent_features
from shelfline.operators.forecast import Fold, actual_units, join_actuals, require_calendar
from shelfline.operators.panel import SERIES, SERIES_ATTRIBUTES
from shelfline.operators.quality import QualityError
from shelfline.session import materialize
from shelfline.settings import DEFAULTS, Settings

KEPT_DAYS = max(*LAGS, *MEAN_DAYS)
MISSING = "Unknown"
# Trees read an unlikely value as a missing one. A regression gets the mean and a mark that it is one.
FILL = -1.0
PRIOR_ROWS = 20.0
GAPS = (*(f"lag_{k}" for k in LAGS), *(f"rolling_std_{k}" for k in SPREAD_DAYS), "sell_price", "price_change_percentage", "days_since_last_sale")
NAME = "global_model"
LEARNERS = ("boosted", "trees", "poisson")
_STATIC = ("item_id", "store_id", "state_id", "category_id", "department_id")


@dataclass(frozen=True)
class Learned:
    model: Trees | Linear
    levels: DataFrame
    """(column, level, code): the frozen vocabulary of every categorical column."""
    overall: float
    """Code of a level that was not in the training data."""
    means: dict[str, float] | None = None
    """What a regression reads for a missing number; None for trees."""
    most: float = float("inf")
    """No forecast is above this: a log link could run away when its own forecasts are its inputs."""
    deviances: tuple[float, ...] = ()
    """Mean deviance of the training rows before each round of a Poisson booster and after the last."""


def fit_levels(train: DataFrame) -> DataFrame:
    """Each category's mean demand in the training data is its code. Trees split ordered categories
    this way in any case, and the vocabulary stays a table however many items there are."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("level"))
        for c in CATEGORICAL
    ])
    return train.select(F.inline(cells), "units_sold").groupBy("column", "level").agg(
        F.avg("units_sold").alias("code"), F.count("units_sold").alias("rows"))


def encode(df: DataFrame, levels: DataFrame, overall: float, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Add `<column>_code`; a level that is not in the vocabulary gets the overall mean."""
    for c in columns:
        codes = levels.filter(F.col("column") == c).select(F.col("level").alias("_level"), F.col("code").alias(f"{c}_code"))
        df = df.join(codes, F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) == F.col("_level"), "left").drop("_level")
        df = df.withColumn(f"{c}_code", F.coalesce(f"{c}_code", F.lit(overall)))
    return df


def shrunk(levels: DataFrame, overall: float, weight: float = PRIOR_ROWS) -> DataFrame:
    """Codes drawn towards the overall mean as if each level had `weight` more rows of it. Training rows get the same code as rows
    to forecast: within a level it is constant, so it says nothing of a single row. (A mean without the row itself would differ
    from row to row by just that row's demand, which trees can read.)"""
    code = (F.col("code") * F.col("rows") + weight * overall) / (F.col("rows") + weight)
    return levels.withColumn("code", code)


def assemble(encoded: DataFrame, means: dict[str, float] | None = None) -> DataFrame:
    """One feature vector per row; with `means`, missing numbers are the mean and have a mark beside them."""
    value = lambda c: F.col(c).cast("double")
    numbers = [F.coalesce(value(c), F.lit(means[c] if means else FILL)).alias(f"_{c}") for c in NUMERIC]
    marks = [F.col(c).isNull().cast("double").alias(f"_no_{c}") for c in GAPS] if means else []
    names = [f"_{c}" for c in NUMERIC] + ([f"_no_{c}" for c in GAPS] if means else [])
    kept = encoded.select("*", *numbers, *marks)
    return VectorAssembler(inputCols=names + [f"{c}_code" for c in CATEGORICAL], outputCol="vector").transform(kept).drop(*names)


def training_rows(sales: DataFrame, origin: dt.date, settings: Settings = DEFAULTS) -> DataFrame:
    """All rows of the year up to the origin that have a full set of lags."""
    return recent_features(sales, origin - dt.timedelta(days=settings.training_days), origin).filter("lag_56 IS NOT NULL")


def train_model(
    sales: DataFrame, origin: dt.date, settings: Settings = DEFAULTS, learner: str = "trees"
) -> Learned:
    """On all training rows: boosted trees with a Poisson loss (`boosted`), with squared loss (`trees`), or a Poisson regression
    (`poisson`)."""
    if learner not in LEARNERS:
        raise ValueError(f"no learner named {learner}")
    train = materialize(training_rows(sales, origin, settings), "training")
    overall, highest = train.agg(F.avg("units_sold"), F.max("units_sold")).first()
    if overall is None:
        raise QualityError("not enough history to train on")
    means = None
    if learner == "poisson":
        found = train.agg(*[F.coalesce(F.avg(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in NUMERIC]).first()
        means = {c: float(found[c]) for c in NUMERIC}
    levels = materialize(shrunk(fit_levels(train), overall), "levels")
    rows = assemble(encode(train, levels, overall), means).select("vector", F.col("units_sold").cast("double").alias("label"))
    most = 2.0 * float(highest)
    if learner == "boosted":
        model, deviances = boost_counts(
            rows.select(vector_to_array("vector").alias("x"), "label"), settings.count_rounds, seed=settings.seed)
        return Learned(model, levels, float(overall), means, most, tuple(deviances))
    common = {"featuresCol": "vector", "labelCol": "label", "predictionCol": "prediction"}
    rows = rows.persist()  # the rounds read these rows once each
    try:
        if learner == "trees":
            fit = GBTRegressor(maxIter=settings.boosting_rounds, maxDepth=DEPTH, stepSize=0.05, seed=settings.seed, **common)
            return Learned(of_boosted(fit.fit(rows), DEPTH), levels, float(overall), means, most)
        return Learned(count_regression(rows, 0.01, 25), levels, float(overall), means, most)
    finally:
        rows.unpersist()


# --- recursive forecast -------------------------------------------------------------------------

def initial_state(sales: DataFrame, origin: dt.date) -> DataFrame:
    """One row per series: its last values, days since its last sale and last known price. The
    value array is as long as the longest lag, whatever the history."""
    past = sales.filter(F.col("date") <= F.lit(origin))
    recent = F.when(F.col("date") > F.date_sub(F.lit(origin), KEPT_DAYS), F.struct("date", F.col("units_sold").cast("double").alias("u")))
    last_sale = F.max(F.when(F.col("units_sold") > 0, F.col("date")))
    return past.groupBy(*SERIES_ATTRIBUTES).agg(
        F.array_sort(F.collect_list(recent))["u"].alias("y"),
        (F.datediff(F.lit(origin), last_sale) + 1).cast("double").alias("gap"),
        F.expr("max_by(sell_price, date) FILTER (WHERE sell_price IS NOT NULL)").alias("sell_price"),
    ).filter(F.size("y") > 0)


def _last(y: Column, k: int) -> Column:
    """The last k values, or all of them where there are fewer."""
    size = F.size(y)
    return F.slice(y, F.greatest(size - k + 1, F.lit(1)), F.lit(k))


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x) / F.size(values)


def _spread(values: Column) -> Column:
    """Sample standard deviation of an array; 0 for a single value."""
    n = F.size(values)
    squares = F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x)
    mean = _mean(values)
    variance = F.greatest(squares - n * mean * mean, F.lit(0.0)) / F.nullif((n - 1).cast("double"), F.lit(0.0))
    return F.coalesce(F.sqrt(variance), F.lit(0.0))


_FACTS = ("y", "gap", "date", "state_id", "snap_CA", "snap_TX", "snap_WI")


def past_features(facts: dict[str, Column] | None = None) -> dict[str, Column]:
    """Features of the day after the array `y` ends. Only `y` itself, which may end in earlier
    forecasts, and facts known in advance enter; the price stays at its last known value."""
    facts = facts or {c: F.col(c) for c in _FACTS}
    y, date = facts["y"], facts["date"]
    features = {f"lag_{k}": F.when(F.size(y) >= k, F.element_at(y, -k)) for k in LAGS}
    features.update({f"rolling_mean_{k}": _mean(_last(y, k)) for k in MEAN_DAYS})
    features.update({f"rolling_std_{k}": _spread(_last(y, k)) for k in SPREAD_DAYS})
    snap = F.when(facts["state_id"] == "CA", facts["snap_CA"])
    for state in ("TX", "WI"):
        snap = snap.when(facts["state_id"] == state, facts[f"snap_{state}"])
    features.update({
        "price_change_percentage": F.lit(0.0), "weekday": sunday_zero_weekday(date), "week": F.weekofyear(date),
        "month": F.month(date), "quarter": F.quarter(date), "snap_flag": snap, "days_since_last_sale": facts["gap"],
    })
    return features


def known_days(calendar: DataFrame, origin: dt.date, horizon: int, learned: Learned) -> DataFrame:
    """What is known in advance about each day to forecast; one row per day."""
    days = calendar.filter((F.col("date") > F.lit(origin)) & (F.col("date") <= F.date_add(F.lit(origin), horizon)))
    facts = days.select(
        "date", "snap_CA", "snap_TX", "snap_WI", F.col("event_type_1").alias("event_type"),
        (F.col("event_name_1").isNotNull() | F.col("event_name_2").isNotNull()).cast("int").alias("event_flag"),
    )
    return encode(facts, learned.levels, learned.overall, ["event_type"])


def _fold(features: dict[str, Column], learned: Learned) -> Column:
    """The features of one row as the model's vector, in the order of `assemble`."""
    value = lambda c: features[c].cast("double")
    means = learned.means
    numbers = [F.coalesce(value(c), F.lit(means[c] if means else FILL)) for c in NUMERIC]
    marks = [value(c).isNull().cast("double") for c in GAPS] if means else []
    return F.array(*numbers, *marks, *(features[f"{c}_code"] for c in CATEGORICAL))


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def forecast_recursively(learned: Learned, sales: DataFrame, calendar: DataFrame, origin: dt.date, horizon: int) -> DataFrame:
    """Day by day for all series: predict, floor at zero, append, go on.

    The days to forecast are a literal array, the model is an expression, and a series is one row whose last values are folded
    over the days. So all steps of all series are one projection: no join, no shuffle and no write between the steps.
    """
    require_calendar(calendar, origin, horizon)
    known = known_days(calendar, origin, horizon, learned).orderBy("date").collect()  # one row per day of the horizon
    kinds = {"date": "date", "snap_CA": "int", "snap_TX": "int", "snap_WI": "int", "event_flag": "int", "event_type_code": "double"}
    days = F.array(*[F.struct(*[F.lit(d[c]).cast(t).alias(c) for c, t in kinds.items()]) for d in known])
    series = initial_state(sales, origin)
    # Work per row, not per byte: adaptive execution would gather these small rows into one task.
    tasks = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    state = encode(series, learned.levels, learned.overall, _STATIC).repartition(tasks, *SERIES)
    zero = F.struct(F.col("y"), F.col("gap"), F.array().cast("array<double>").alias("forecasts"))

    def step(before: Column, day: Column) -> Column:
        facts = {c: day[c] for c in kinds} | {"y": before["y"], "gap": before["gap"], "state_id": F.col("state_id")}
        features = facts | {c: F.col(c) for c in ("sell_price", *(f"{c}_code" for c in _STATIC))} | past_features(facts)

        def after(units: Column) -> Column:
            return F.struct(
                _last(F.concat(before["y"], F.array(units)), KEPT_DAYS).alias("y"),
                F.when(units > 0, F.lit(1.0)).otherwise(before["gap"] + 1).alias("gap"),
                F.concat(before["forecasts"], F.array(units)).alias("forecasts"))

        predict = lambda x: F.least(F.greatest(learned.model.predict(x), F.lit(0.0)), F.lit(learned.most))
        return _let(_let(_fold(features, learned), predict), after)

    folded = state.select(*SERIES_ATTRIBUTES, F.aggregate(days, zero, step)["forecasts"].alias("forecasts"))
    out = folded.select(*SERIES_ATTRIBUTES, F.posexplode("forecasts").alias("_n", "forecast_units"))
    date = F.date_add(F.lit(origin), F.col("_n") + 1)
    return out.select(
        *SERIES_ATTRIBUTES, F.lit(origin).alias("origin"), date.alias("date"), date_key(date).alias("date_key"),
        (F.col("_n") + 1).alias("horizon"), F.lit(NAME).alias("model"), "forecast_units",
    )


def learned_forecast(
    sales: DataFrame, calendar: DataFrame, origin: dt.date, horizon: int, settings: Settings = DEFAULTS, learner: str = "trees",
) -> DataFrame:
    return forecast_recursively(train_model(sales, origin, settings, learner), sales, calendar, origin, horizon)


def backtest_rows(
    baselines: DataFrame, sales: DataFrame, calendar: DataFrame, folds: Sequence[Fold], horizon: int,
    settings: Settings = DEFAULTS, learner: str = "trees",
) -> DataFrame:
    """The learned model in every fold, trained anew on what was known at its origin, next to the outcomes and with the error
    scales of the baselines' rows."""
    scales = baselines.filter("model = 'naive' AND horizon = 1").select(*SERIES, "fold", "split_role", "scale")
    actuals = actual_units(sales, min(f.origin for f in folds))
    rows = []
    for fold in folds:
        predicted = learned_forecast(sales, calendar, fold.origin, horizon, settings, learner)
        rows.append(join_actuals(predicted.join(scales.filter(F.col("fold") == fold.number), SERIES), actuals))
    return reduce(DataFrame.unionByName, rows)

