"""Late-delivery classifiers: split, weights, stops, metrics and a planted signal."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfline.operators import risk
from shelfline.operators.quality import QualityError
from shelfline.settings import Settings

FEW = Settings(forest_trees=5, classifier_rounds=5)


def orders(spark, late, days=50, per_day=8):
    """Orders over `days`; `late(i, mode)` says which are late."""
    modes = ("air", "ship", "rail")
    rows = []
    for i in range(days * per_day):
        mode = modes[i % 3]
        rows.append((i, dt.date(2020, 1, 1) + dt.timedelta(days=i // per_day), mode, "m", f"r{i % 4}", "s", 3.0 + i % 2, True, int(late(i, mode))))
    return spark.createDataFrame(
        rows, "order_id long, order_date date, shipping_mode string, market string, region string, customer_segment string, "
        "scheduled_shipping_days double, delivery_eligible boolean, late_order int")


@pytest.fixture(scope="module")
def fitted(spark):
    delivery = orders(spark, lambda i, mode: mode == "ship" if i % 7 else i % 2)
    return delivery, *risk.fit_risk_models(delivery, FEW)


def test_split_is_by_date(spark):
    delivery = orders(spark, lambda i, mode: i % 2)
    train, test = risk.split_orders(delivery)
    cut = dt.date(2020, 1, 1) + dt.timedelta(days=40)  # the 41st of 50 dates
    assert train.agg(F.max("order_date")).first()[0] < cut == test.agg(F.min("order_date")).first()[0]
    assert train.count() + test.count() == delivery.count()


def test_ineligible_orders_are_left_out(spark):
    delivery = orders(spark, lambda i, mode: i % 2).withColumn("delivery_eligible", F.col("order_id") % 5 != 0)
    train, test = risk.split_orders(delivery)
    assert train.unionByName(test.withColumn("weight", F.lit(1.0))).filter("order_id % 5 = 0").count() == 0


def test_weights_balance_the_outcomes(spark):
    train, _ = risk.split_orders(orders(spark, lambda i, mode: i % 4 == 0))
    sums = {r["label"]: r["w"] for r in train.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert sums[0.0] == pytest.approx(sums[1.0]) and sum(sums.values()) == pytest.approx(train.count())


@pytest.mark.parametrize("late", [lambda i, mode: 1, lambda i, mode: 0, lambda i, mode: i < 8 * 40 and i % 2])
def test_both_outcomes_are_needed_on_both_sides(spark, late):
    with pytest.raises(QualityError, match="both outcomes"):
        risk.split_orders(orders(spark, late))


def test_no_dates_to_split(spark):
    with pytest.raises(QualityError):
        risk.split_orders(orders(spark, lambda i, mode: 1).filter("order_id < 0"))


def test_every_model_finds_a_planted_signal(fitted):
    delivery, scores, _ = fitted
    held_out = risk.split_orders(delivery)[1]
    metrics = {r["model"]: r for r in risk.risk_metrics(scores).collect()}
    assert set(metrics) == set(risk.classifiers(FEW))
    for row in metrics.values():
        assert row["roc_auc"] > 0.8
        assert row["tn"] + row["fp"] == held_out.filter("label = 0").count()
        assert row["fn"] + row["tp"] == held_out.filter("label = 1").count()


def test_weights_are_named_after_their_features(fitted):
    _, _, weights = fitted
    by = {}
    for r in weights.collect():
        by.setdefault(r["model"], {})[r["feature"]] = r["importance"]
    names = {frozenset(w) for w in by.values()}
    assert len(names) == 1 and len(by) == 4
    strongest = {max((n for n in w if "shipping_mode" in n), key=lambda n: abs(w[n])) for m, w in by.items() if m != "logistic_regression"}
    assert all("ship" in n for n in strongest)
    assert by["logistic_regression"]["shipping_mode_hot_ship"] == max(by["logistic_regression"].values())


def test_metrics_with_zero_denominators(spark):
    scores = spark.createDataFrame([("m", i, float(i % 2), 0.1) for i in range(10)], "model string, order_id long, label double, probability double")
    row = risk.risk_metrics(scores).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    assert row["tn"] == row["fn"] == 5 and row["tp"] == row["fp"] == 0


def brute_areas(rows):
    late, timely = [p for y, p in rows if y], [p for y, p in rows if not y]
    roc = sum((a > b) + (a == b) / 2 for a in late for b in timely) / (len(late) * len(timely))
    ap = 0.0
    for cut in sorted({p for _, p in rows}, reverse=True):
        above, own = [y for y, p in rows if p >= cut], [y for y, p in rows if p == cut]
        ap += sum(own) / len(late) * sum(above) / len(above)
    return roc, ap


def test_areas_with_ties_in_many_ranges(spark):
    r = random.Random(2)
    rows = [(m, i, float(r.random() < 0.3), round(r.random(), d)) for m, d in (("fine", 6), ("tied", 1)) for i in range(400)]
    rows += [("same", i, float(i % 3 == 0), 0.5) for i in range(300)] + [("one kind", i, 1.0, r.random()) for i in range(50)]
    scores = spark.createDataFrame(rows, "model string, order_id long, label double, probability double")
    got = {x["model"]: x for x in risk.areas(scores).collect()}
    for model in ("fine", "tied", "same"):
        roc, ap = brute_areas([(y, p) for m, _, y, p in rows if m == model])
        assert got[model]["roc_auc"] == pytest.approx(roc) and got[model]["pr_auc"] == pytest.approx(ap)
    assert got["one kind"]["roc_auc"] is None and got["one kind"]["pr_auc"] is None
    assert risk.areas(scores.limit(0)).collect() == []


def test_learners_read_as_many_rows_as_there_are_different_orders(spark):
    few, many = orders(spark, lambda i, mode: i % 2), orders(spark, lambda i, mode: i % 2, per_day=80)
    sizes = []
    for delivery in (few, many):
        train, _ = risk.split_orders(delivery)
        cells = risk.cells(train)
        sizes.append(cells.count())
        assert cells.agg(F.sum("weight")).first()[0] == pytest.approx(train.count())
    assert sizes[0] == sizes[1]


def test_orders_without_a_value_get_scores(spark):
    delivery = orders(spark, lambda i, mode: mode == "ship" if i % 7 else i % 2).withColumns({
        "region": F.when(F.col("order_id") % 4 != 1, F.col("region")),
        "scheduled_shipping_days": F.when(F.col("order_id") % 5 != 2, F.col("scheduled_shipping_days"))})
    scores, _ = risk.fit_risk_models(delivery, Settings(forest_trees=2, classifier_rounds=2))
    held_out = risk.split_orders(delivery)[1]
    assert scores.groupBy("order_id").count().filter("count = 4").count() == held_out.count()
    assert scores.filter("probability is null or probability < 0 or probability > 1").count() == 0
