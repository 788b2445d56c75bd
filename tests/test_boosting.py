"""Boosted counts against a booster in plain Python, and models as expressions against the models."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import functions as F

from shelfline.operators import boosting
from shelfline.operators.quality import QualityError


def counts(n=200, seed=4):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [r.uniform(-1, 1), r.uniform(-1, 1), r.uniform(0, 1)]
        mean = math.exp(1.2 * x[0] + (0.8 if x[1] > 0.1 else -0.5))
        y, p, u = 0, math.exp(-mean), r.random()
        while u > p and y < 50:
            u -= p
            y += 1
            p *= mean / y
        rows.append((x, float(y)))
    return rows


def plain_tree(x, z, w, depth):
    """The split of the largest weighted variance reduction, at the middle between neighbouring values, until the depth."""
    mean = sum(a * b for a, b in zip(z, w)) / sum(w)
    best = None
    if depth:
        spread = lambda some: sum(w[i] * z[i] ** 2 for i in some) - sum(w[i] * z[i] for i in some) ** 2 / sum(w[i] for i in some)
        whole = spread(range(len(x)))
        for f in range(len(x[0])):
            order = sorted(range(len(x)), key=lambda i: x[i][f])
            for k in range(1, len(order)):
                low, high = x[order[k - 1]][f], x[order[k]][f]
                if low == high:
                    continue
                gain = whole - spread(order[:k]) - spread(order[k:])
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = gain, f, (low + high) / 2
    if best is None:
        return mean
    _, f, cut = best
    sides = [[i for i in range(len(x)) if (x[i][f] > cut) == right] for right in (False, True)]
    return f, cut, *(plain_tree([x[i] for i in s], [z[i] for i in s], [w[i] for i in s], depth - 1) for s in sides)


def cell(tree, x, path=""):
    while isinstance(tree, tuple):
        right = x[tree[0]] > tree[1]
        tree, path = tree[2 + right], path + "lr"[right]
    return path


def plain_boost(rows, rounds, depth, step, ridge):
    x, y = [r[0] for r in rows], [r[1] for r in rows]
    score = [math.log(sum(y) / len(y))] * len(y)
    deviance = lambda: 2 * sum((b * math.log(b / math.exp(s)) if b else 0) - (b - math.exp(s)) for b, s in zip(y, score)) / len(y)
    found = [deviance()]
    for _ in range(rounds):
        mu = [math.exp(s) for s in score]
        tree = plain_tree(x, [b / m - 1 for b, m in zip(y, mu)], mu, depth)
        cells = [cell(tree, v) for v in x]
        for c in set(cells):
            own = [i for i, d in enumerate(cells) if d == c]
            value = step * sum(y[i] - mu[i] for i in own) / (sum(mu[i] for i in own) + ridge)
            for i in own:
                score[i] += value
        found.append(deviance())
    return score, found


def test_boosting_equals_a_plain_one(spark):
    rows = counts()
    df = spark.createDataFrame(rows, "x array<double>, label double")
    model, deviances = boosting.boost_counts(df, rounds=10, depth=3, step=0.3, ridge=1.0, bins=256)
    score, found = plain_boost(rows, 10, 3, 0.3, 1.0)
    assert deviances == pytest.approx(found, rel=1e-9)
    assert all(b < a for a, b in zip(deviances, deviances[1:]))
    got = [r["p"] for r in df.select(model.predict(F.col("x")).alias("p")).collect()]
    assert got == pytest.approx([math.exp(s) for s in score], rel=1e-9)
    assert boosting.walk(model, np.array([r[0] for r in rows])) == pytest.approx(score, rel=1e-9)


def test_ill_posed_counts(spark):
    build = lambda labels: spark.createDataFrame([([1.0, float(i)], v) for i, v in enumerate(labels)], "x array<double>, label double")
    for wrong in ([], [1.0, -1.0], [1.0, None]):
        with pytest.raises(QualityError):
            boosting.boost_counts(build(wrong), 2)
    model, deviances = boosting.boost_counts(build([0.0] * 5), 2)
    assert deviances == [0.0] and build([0.0]).select(model.predict(F.col("x"))).first()[0] < 1e-6
    same, _ = boosting.boost_counts(build([2.0] * 30), 2)
    assert build([2.0]).select(same.predict(F.col("x"))).first()[0] == pytest.approx(2.0)


def test_expressions_score_as_their_models(spark):
    df = spark.createDataFrame(counts(300), "x array<double>, label double").withColumn("features", array_to_vector("x"))
    trees = GBTRegressor(labelCol="label", maxIter=7, maxDepth=4, stepSize=0.2).fit(df)
    single = DecisionTreeRegressor(labelCol="label", maxDepth=4, minInstancesPerNode=40).fit(df)  # leaves above the last level
    linear = GeneralizedLinearRegression(labelCol="label", family="poisson", link="log").fit(df)
    one = boosting.Trees(4)
    one.add(*boosting.complete(single.toDebugString, 4)[0])
    for model, own in ((trees, boosting.of_boosted(trees, 4)), (single, one), (linear, boosting.of_linear(linear))):
        both = model.transform(df).select("prediction", own.predict(F.col("x")).alias("own")).collect()
        assert [r["own"] for r in both] == pytest.approx([r["prediction"] for r in both], rel=1e-12)


def heavy_counts(spark):
    """Mostly small counts, and a few rows whose features and counts are hundreds of times larger."""
    rows = [([float(i % 5), 0.0], float((i * 7) % 3)) for i in range(400)] + [([400.0 + i, 1.0], 400.0 + i) for i in range(3)]
    return spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("vector"), "label")


def test_a_count_regression_with_few_heavy_rows_lowers_the_deviance(spark):
    rows = heavy_counts(spark)
    model = boosting.guarded_regression(rows, 0.0, 25)
    scored = [(r["label"], model.intercept + float(np.dot(model.weights, r["vector"].toArray()))) for r in rows.collect()]
    mean = sum(y for y, _ in scored) / len(scored)
    loss = sum(math.exp(at) - y * at for y, at in scored)
    assert loss < sum(mean - y * math.log(mean) for y, _ in scored)
    # The gradient vanishes at the least deviance.
    assert sum(math.exp(at) - y for y, at in scored) == pytest.approx(0, abs=0.05 * mean)


def test_a_fit_that_spark_gives_up_is_finished_with_halved_steps(spark, monkeypatch):
    from py4j.protocol import Py4JJavaError

    class Stops:
        def __init__(self, **_):
            pass

        def fit(self, _):
            error = Py4JJavaError.__new__(Py4JJavaError)
            error.java_exception = "java.lang.AssertionError: assertion failed: Sum of weights cannot be zero."
            raise error

    monkeypatch.setattr(boosting, "GeneralizedLinearRegression", Stops)
    model = boosting.count_regression(heavy_counts(spark), 0.01, 25)
    assert model.log and all(map(math.isfinite, [*model.weights, model.intercept]))


def test_a_round_walks_the_last_tree_only(spark, monkeypatch):
    walked = []
    total = boosting.Trees.total
    monkeypatch.setattr(boosting.Trees, "total", lambda self, x: walked.append(self.count) or total(self, x))
    rows = spark.createDataFrame([(x, y) for x, y in counts(60)], "x array<double>, label double")
    boosting.boost_counts(rows, 10, depth=2)
    assert set(walked) == {1}
