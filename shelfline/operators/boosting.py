"""Boosted trees with a Poisson loss, and fitted models as plain column expressions.

Spark's own boosting knows squared and absolute loss only. A Newton step for counts with a log link is a regression tree on the
working response (y - mu) / mu with the weight mu: its gain is the one of the second-order expansion of the loss. The tree gives
the cells; their values are taken anew from one aggregate of gradients and Hessians, which also gives the deviance.

A fitted model is a few literal arrays that built-in functions walk, so it can be scored inside any expression, also inside a
fold over the days of a forecast.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GeneralizedLinearRegression, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.quality import QualityError
from shelfline.session import discard, materialize

DEPTH, BINS, STEP, RIDGE = 5, 32, 0.1, 1.0
WRITE_EVERY = 8
LARGEST_LOG = 15.0

_SPLIT = re.compile(r"If \(feature (\d+) <= ([-+0-9.Ee]+|Infinity|NaN)\)")
_VALUE = re.compile(r"Predict: (\S+)")


def _items(values, kind: str) -> Column:
    """An array literal: one constant that the optimizer folds, however many numbers it holds."""
    return F.split(F.lit(",".join("Infinity" if v == math.inf else repr(v) for v in values)), ",").cast(f"array<{kind}>")


@dataclass
class Trees:
    """Complete binary trees of one depth, one after the other: inner nodes level by level, then leaf values. A row goes to the
    right child of node n, 2n + 2, if its feature is above the threshold, else to the left one, 2n + 1."""

    depth: int = DEPTH
    start: float = 0.0
    log: bool = False
    features: list[int] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)
    values: list[float] = field(default_factory=list)

    @property
    def inner(self) -> int:
        return (1 << self.depth) - 1

    @property
    def count(self) -> int:
        return len(self.values) // (self.inner + 1)

    def add(self, features: list[int], thresholds: list[float], values: list[float]) -> None:
        self.features += features
        self.thresholds += thresholds
        self.values += values

    def leaf(self, x: Column, tree: Column) -> Column:
        """The leaf (from 0) of the row with features `x` (array of double) in one tree."""
        features, thresholds = _items(self.features, "int"), _items(self.thresholds, "double")

        def down(node: Column, _: Column) -> Column:
            at = tree * self.inner + node
            return node * 2 + F.when(F.get(x, F.get(features, at)) > F.get(thresholds, at), 2).otherwise(1)

        return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.lit(0), down) - self.inner

    def total(self, x: Column) -> Column:
        """Sum of all trees' values, and the start."""
        if not self.count:
            return F.lit(self.start)
        values = _items(self.values, "double")
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(self.count - 1)), F.lit(float(self.start)),
            lambda total, tree: total + F.get(values, tree * (self.inner + 1) + self.leaf(x, tree)))

    def predict(self, x: Column) -> Column:
        return F.exp(F.greatest(F.least(self.total(x), F.lit(LARGEST_LOG)), F.lit(-LARGEST_LOG))) if self.log else self.total(x)


@dataclass
class Linear:
    """Weights and an intercept, with a log link or none."""

    weights: list[float]
    intercept: float
    log: bool

    def predict(self, x: Column) -> Column:
        terms = F.zip_with(x, _items(self.weights, "double"), lambda a, b: a * b)
        total = F.aggregate(terms, F.lit(float(self.intercept)), lambda s, t: s + t)
        return F.exp(total) if self.log else total


def complete(debug: str, depth: int) -> list[tuple[list[int], list[float], list[float]]]:
    """The trees in a model's printed form, filled up to one depth: below an early leaf every row goes left to its value."""
    lines = [line.strip() for line in debug.splitlines() if re.match(r"\s*(If|Else|Predict)", line)]
    out, at = [], 0

    def read(node: int, level: int, features: list[int], thresholds: list[float], values: list[float]) -> None:
        nonlocal at
        found = _SPLIT.match(lines[at])
        at += 1
        if not found:
            value = float(_VALUE.match(lines[at - 1])[1])
            first = (node + 1) * (1 << (depth - level)) - (1 << depth)
            values[first : first + (1 << (depth - level))] = [value] * (1 << (depth - level))
            return
        features[node], thresholds[node] = int(found[1]), float(found[2])
        read(2 * node + 1, level + 1, features, thresholds, values)
        at += 1  # the line of Else
        read(2 * node + 2, level + 1, features, thresholds, values)

    while at < len(lines):
        tree = [0] * ((1 << depth) - 1), [math.inf] * ((1 << depth) - 1), [0.0] * (1 << depth)
        read(0, 0, *tree)
        out.append(tree)
    return out


def of_boosted(model, depth: int) -> Trees:
    """Spark's boosted regression trees, each tree's values times its weight."""
    trees = Trees(depth)
    for weight, tree in zip(model.treeWeights, complete(model.toDebugString, depth), strict=True):
        trees.add(tree[0], tree[1], [weight * v for v in tree[2]])
    return trees


def _mean(score: str) -> Column:
    return F.exp(F.greatest(F.least(F.col(score), F.lit(LARGEST_LOG)), F.lit(-LARGEST_LOG)))


def boost_counts(
    rows: DataFrame, rounds: int, depth: int = DEPTH, step: float = STEP, ridge: float = RIDGE, bins: int = BINS, seed: int = 42,
) -> tuple[Trees, list[float]]:
    """Trees for the mean of a count, and the mean Poisson deviance before each round and after the last.

    `rows`: x (array of double without nulls) and label (zero or more). Each round reads all rows twice besides the tree's own
    passes and walks the last round's tree only, since the sum of the trees before stays beside the row; the scores are written every
    WRITE_EVERY rounds, which bounds the plans and what a lost executor costs. A cell's value
    is step * sum(y - mu) / (sum(mu) + ridge). Labels that are all zero give no trees. No rows, or a negative or unknown
    label, stop with an error.
    """
    n, total, least, unknown = rows.agg(
        F.count("*"), F.sum(F.col("label").cast("double")), F.min("label"), F.count_if(F.col("label").isNull())).first()
    if not n or unknown or least < 0:
        raise QualityError("a count model needs rows, all with a count of zero or more")
    if not total:
        return Trees(depth, -LARGEST_LOG, True), [0.0]
    model = Trees(depth, math.log(total / n), True)
    stored = materialize(rows.select("x", F.col("label").cast("double").alias("label"), F.lit(model.start).alias("score")), "boosting")
    current = stored.withColumn("added", F.lit(0.0))  # the trees since the last write
    last, kept = Trees(depth), None
    y, mu = F.col("label"), _mean("score")
    loss = 2 * (F.when(y > 0, y * F.log(y / mu)).otherwise(0.0) - (y - mu))
    learner = DecisionTreeRegressor(
        featuresCol="vector", labelCol="response", weightCol="weight", maxDepth=depth, maxBins=bins, seed=seed)
    deviances = []
    for turn in range(rounds + 1):
        if last.count:
            current = current.withColumn("added", F.col("added") + last.total(F.col("x")))
            if turn % WRITE_EVERY == 0 and turn < rounds:
                written = materialize(current.select("x", "label", (F.col("score") + F.col("added")).alias("score")), "boosting")
                discard(stored)
                stored, current = written, written.withColumn("added", F.lit(0.0))
        scored = current.withColumns({"base": F.col("score"), "score": F.col("score") + F.col("added")})
        if turn == rounds:
            deviances.append(scored.agg(F.avg(loss)).first()[0])
            break
        scored = scored.withColumns({"vector": array_to_vector("x"), "response": y / mu - 1, "weight": mu}).persist()
        fitted = learner.fit(scored.select("vector", "response", "weight"))
        if kept is not None:
            kept.unpersist()
        features, thresholds, _ = complete(fitted.toDebugString, depth)[0]
        cells = Trees(depth, features=features, thresholds=thresholds)
        sums = scored.groupBy(cells.leaf(F.col("x"), F.lit(0)).alias("leaf")).agg(
            F.sum(y - mu).alias("g"), F.sum(mu).alias("h"), F.sum(loss).alias("loss")).collect()  # one row per leaf
        values = [0.0] * (1 << depth)
        for r in sums:
            values[r["leaf"]] = step * r["g"] / (r["h"] + ridge)
        deviances.append(math.fsum(r["loss"] for r in sums) / n)
        model.add(features, thresholds, values)
        last = Trees(depth, features=features, thresholds=thresholds, values=values)
        # The next round starts from these rows, which stay until its own are in memory.
        current, kept = scored.select("x", "label", F.col("base").alias("score"), "added"), scored
    if kept is not None:
        kept.unpersist()
    discard(stored)
    return model, deviances


TOLERANCE, HALVINGS = 1e-6, 16


def count_regression(rows: DataFrame, penalty: float, steps: int) -> Linear:
    """Poisson regression with a log link. Spark's own takes whole steps of reweighted least squares; where a few rows have far larger
    counts than the others these can go back and forth until every weight is zero or infinite, and the fit stops with an error. Then
    the same steps are taken from the mean, each as far as the deviance falls (`guarded_regression`).

    `rows`: vector and label (zero or more).
    """
    whole = GeneralizedLinearRegression(
        family="poisson", link="log", regParam=penalty, maxIter=steps, featuresCol="vector", labelCol="label", predictionCol="prediction")
    try:
        model = of_linear(whole.fit(rows))
        if all(map(math.isfinite, [*model.weights, model.intercept])):
            return model
    except Py4JJavaError as error:
        if "Sum of weights cannot be zero" not in str(error.java_exception):
            raise
    return guarded_regression(rows, penalty, steps)


def guarded_regression(rows: DataFrame, penalty: float, steps: int) -> Linear:
    """Each step is halved until the deviance does not rise; one job tries all halves. Spark's inner fit scales the response and with it
    the penalty, which is undone here."""
    y = F.col("label")
    rows = rows.select("vector", y, F.concat(vector_to_array("vector"), F.array(F.lit(1.0))).alias("x"))
    overall, width = rows.agg(F.avg("label"), F.max(F.size("x"))).first()
    model = [0.0] * (width - 1) + [math.log(overall) if overall else -LARGEST_LOG]
    least = math.inf

    def score(weights: list[float]) -> Column:
        return F.aggregate(F.zip_with("x", _items(weights, "double"), lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t)

    for _ in range(steps if overall else 0):
        mu = F.exp(F.greatest(F.least(F.col("at"), F.lit(600.0)), F.lit(-36.0)))
        working = rows.withColumn("at", score(model)).withColumns({"response": F.col("at") + (y - mu) / mu, "weight": mu})
        n, s, q = working.agg(
            F.sum("weight"), F.sum(F.col("weight") * F.col("response")), F.sum(F.col("weight") * F.col("response") * F.col("response"))).first()
        learner = LinearRegression(featuresCol="vector", labelCol="response", weightCol="weight", solver="normal", standardization=False,
                                   regParam=penalty * math.sqrt(max(q / n - (s / n) ** 2, 0.0)))
        fit = learner.fit(working.select("vector", "response", "weight"))
        goal = [*map(float, fit.coefficients.toArray()), float(fit.intercept)]
        shares = [0.5 ** k for k in range(HALVINGS + 1)]
        tried = rows.select(y, score(model).alias("at"), score(goal).alias("to"))
        # The part of the deviance that depends on the model.
        losses = [F.avg(F.exp(F.col("at") + share * (F.col("to") - F.col("at"))) - y * (F.col("at") + share * (F.col("to") - F.col("at"))))
                  for share in (0.0, *shares)]
        now, *found = tried.agg(*losses).first()
        least = min(least, now)
        share = next((t for t, loss in zip(shares, found, strict=True) if loss <= least + TOLERANCE * abs(least)), 0.0)
        moved = [a + share * (b - a) for a, b in zip(model, goal, strict=True)]
        change = max(abs(a - b) for a, b in zip(moved, model, strict=True))
        model = moved
        if change < TOLERANCE:
            break
    return Linear(model[:-1], model[-1], True)


def of_linear(model) -> Linear:
    return Linear([float(w) for w in model.coefficients.toArray()], float(model.intercept), model.getLink() == "log")


def walk(trees: Trees, x: np.ndarray) -> np.ndarray:
    """The same sums on the driver, for a few rows."""
    out = np.full(len(x), trees.start)
    features, thresholds = np.array(trees.features), np.array(trees.thresholds)
    for t in range(trees.count):
        node = np.zeros(len(x), int)
        for _ in range(trees.depth):
            at = t * trees.inner + node
            node = 2 * node + 1 + (x[np.arange(len(x)), features[at]] > thresholds[at])
        out += np.array(trees.values)[t * (trees.inner + 1) + node - trees.inner]
    return out
