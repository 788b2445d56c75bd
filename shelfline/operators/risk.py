"""Late-delivery classifiers over the order fact."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.columns import ratio
from shelfline.operators.ordered import running_totals_within
from shelfline.operators.quality import QualityError
from shelfline.session import materialize
from shelfline.settings import DEFAULTS, Settings

# What is known when an order is placed.
CATEGORIES = ("shipping_mode", "market", "region", "customer_segment")
NUMBER = "scheduled_shipping_days"
THRESHOLD = 0.5
CHUNKS = 64
"""Parts into which equal training orders are dealt for a learner that draws its rows."""
CELLS_PER_TASK = 50_000


def split_date(eligible: DataFrame, share: float = 0.8) -> dt.date:
    """The date at position int(share * n) of the n order dates; the window sees one row per date."""
    dates = eligible.select("order_date").distinct()
    placed = dates.withColumn("at", F.row_number().over(Window.orderBy("order_date")) - 1)
    row = placed.filter(F.col("at") == F.floor(F.lit(share) * dates.agg(F.count(F.lit(1))).scalar())).first()
    if row is None:
        raise QualityError("no order dates to split")
    return row["order_date"]


def split_orders(delivery: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) by date, both holding both outcomes."""
    eligible = delivery.filter("delivery_eligible").select(
        "order_id", "order_date", *CATEGORIES, NUMBER, F.col("late_order").cast("double").alias("label")
    )
    cut = split_date(eligible)
    counts = eligible.agg(*[
        F.count_if((F.col("label") == y) & side).alias(f"{name}{y}")
        for y in (0, 1) for name, side in (("train", F.col("order_date") < F.lit(cut)), ("test", F.col("order_date") >= F.lit(cut)))
    ]).first()
    if min(counts) == 0:
        raise QualityError("the risk model needs both outcomes before and after the split date")
    train, test = eligible.filter(F.col("order_date") < F.lit(cut)), eligible.filter(F.col("order_date") >= F.lit(cut))
    n, late = counts["train0"] + counts["train1"], counts["train1"]
    weight = F.when(F.col("label") == 1, n / (2 * late)).otherwise(n / (2 * (n - late)))
    return train.withColumn("weight", weight), test


def preparation() -> list:
    """One-hot categories, the number imputed and scaled, all in one vector. The categories are
    dimensions with a handful of values each."""
    return [
        StringIndexer(inputCols=list(CATEGORIES), outputCols=[f"{c}_index" for c in CATEGORIES], handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_index" for c in CATEGORIES], outputCols=[f"{c}_hot" for c in CATEGORIES]),
        Imputer(inputCols=[NUMBER], outputCols=[f"{NUMBER}_filled"]),
        VectorAssembler(inputCols=[f"{NUMBER}_filled"], outputCol="_number"),
        StandardScaler(inputCol="_number", outputCol=f"{NUMBER}_scaled", withMean=True),
        VectorAssembler(inputCols=[*[f"{c}_hot" for c in CATEGORIES], f"{NUMBER}_scaled"], outputCol="features"),
    ]


def classifiers(settings: Settings = DEFAULTS) -> dict:
    common = {"labelCol": "label", "weightCol": "weight", "featuresCol": "features"}
    seeded = {**common, "seed": settings.seed}
    return {
        "logistic_regression": LogisticRegression(maxIter=100, **common),
        "decision_tree": DecisionTreeClassifier(maxDepth=5, **seeded),
        "random_forest": RandomForestClassifier(numTrees=settings.forest_trees, maxDepth=8, **seeded),
        "boosted_trees": GBTClassifier(maxIter=settings.classifier_rounds, maxDepth=5, **seeded),
    }


def _feature_names(prepared: DataFrame) -> list[str]:
    groups = prepared.schema["features"].metadata["ml_attr"]["attrs"]
    named = sorted((a["idx"], a["name"]) for kind in groups.values() for a in kind)
    return [name for _, name in named]


def cells(rows: DataFrame, *keys: str) -> DataFrame:
    """Weighted training rows with equal features, outcome and `keys` as one row with their weights added up: the same loss for a
    learner that knows weights. There are as many as there are different orders, however many orders there are."""
    return rows.groupBy(*CATEGORIES, NUMBER, "label", *keys).agg(F.sum("weight").alias("weight"))


def few_parts(df: DataFrame) -> DataFrame:
    """A stored table in as many parts as its rows need. A learner passes over it hundreds of times, each time with a task a part."""
    return df.repartition(1 + df.count() // CELLS_PER_TASK)


def fit_risk_models(delivery: DataFrame, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """(test scores of every model, feature weights of every model).

    The vocabulary, means and weights come from all training orders; the learners read them as `cells`. The forest draws its
    rows, so for it each cell is dealt into CHUNKS parts. Equal features have equal scores: each model scores the different test
    orders once, in a job of its own, and they are joined back to all of them.
    """
    train, test = split_orders(delivery)
    train = materialize(train, "risk_training")
    prepare = Pipeline(stages=preparation()).fit(train)
    chunk = F.pmod(F.xxhash64("order_id", F.lit(settings.seed)), F.lit(CHUNKS)).alias("chunk")
    dealt = materialize(cells(train.select("*", chunk), "chunk"), "risk_chunks")
    whole = materialize(cells(dealt), "risk_cells")
    # Every learner reads its rows many times.
    ready = {chunked: prepare.transform(few_parts(rows)).persist() for chunked, rows in ((True, dealt), (False, whole))}
    names = _feature_names(ready[False])
    features = [*CATEGORIES, NUMBER]
    held_out = prepare.transform(materialize(test.select(*features).distinct(), "risk_held_out"))
    scores, weights = [], []
    try:
        for name, learner in classifiers(settings).items():
            model = learner.fit(ready[name == "random_forest"])
            scores.append(materialize(model.transform(held_out).select(
                *[F.col(c).alias(f"_{c}") for c in features], F.lit(name).alias("model"),
                vector_to_array("probability")[1].alias("probability")), "risk_cell_scores"))
            values = model.coefficients if name == "logistic_regression" else model.featureImportances
            weights += [(name, feature, float(v)) for feature, v in zip(names, values.toArray())]
    finally:
        for rows in ready.values():
            rows.unpersist()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in features])
    scored = test.join(reduce(DataFrame.unionByName, scores), same).select("model", "order_id", "label", "probability")
    # One row per model and feature.
    return materialize(scored, "risk_scores"), delivery.sparkSession.createDataFrame(
        weights, "model string, feature string, importance double")


def risk_metrics(scores: DataFrame) -> DataFrame:
    """Counts and rates at the threshold, and the areas under both curves, per model."""
    predicted, late = F.col("probability") >= THRESHOLD, F.col("label") == 1
    counted = scores.groupBy("model").agg(
        F.count_if(~predicted & ~late).alias("tn"), F.count_if(predicted & ~late).alias("fp"),
        F.count_if(~predicted & late).alias("fn"), F.count_if(predicted & late).alias("tp"),
    ).withColumns({
        "precision": F.coalesce(ratio("tp", F.col("tp") + F.col("fp")), F.lit(0.0)),
        "recall": F.coalesce(ratio("tp", F.col("tp") + F.col("fn")), F.lit(0.0)),
        "f1": F.coalesce(ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)),
        "threshold": F.lit(THRESHOLD),
    })
    return counted.join(areas(scores), "model")


def areas(scores: DataFrame) -> DataFrame:
    """Areas under the receiver and the precision-recall curve of all models at once, exact with ties.

    Equal scores are counted first; their order is taken in ranges, so neither a model with very many scores nor a score that most
    rows share meets in one task. The first area is the share of pairs of a late and a timely order in which the late one scores
    higher, a tie counting one half; the second adds up precision times the recall gained at each score (average precision).
    Null for a model whose rows are all of one kind.
    """
    counted = scores.groupBy("model", "probability").agg(
        F.count_if(F.col("label") == 1).alias("late"), F.count_if(F.col("label") != 1).alias("timely"))
    placed = running_totals_within(counted, ["model"], [F.desc("probability")], ["late", "timely"])
    seen = F.col("prior_late") + F.col("late")
    pairs = F.col("timely") * (F.col("prior_late") + F.col("late") / 2)
    gained = F.col("late") * seen / (seen + F.col("prior_timely") + F.col("timely"))
    both = (F.max("total_late") > 0) & (F.max("total_timely") > 0)
    return placed.groupBy("model").agg(
        F.when(both, F.sum(pairs) / F.nullif(F.max("total_late") * F.max("total_timely"), F.lit(0))).alias("roc_auc"),
        F.when(both, F.sum(gained) / F.nullif(F.max("total_late"), F.lit(0))).alias("pr_auc"))


def rate_scores(delivery: DataFrame, models: dict[str, tuple[str, ...]]) -> DataFrame:
    """Reference scores without a fit: for each model the late rate, before the split date, of orders with the same values in its
    columns; orders with values not seen then get the overall rate."""
    train, test = split_orders(delivery)
    overall = train.agg(F.avg("label")).first()[0]
    rows = []
    for name, columns in models.items():
        rates = train.groupBy(*columns).agg(F.avg("label").alias("rate"))
        rows.append(test.join(rates, list(columns), "left").select(
            F.lit(name).alias("model"), "order_id", "label", F.coalesce("rate", F.lit(overall)).alias("probability")))
    return materialize(reduce(DataFrame.unionByName, rows), "rate_scores")
