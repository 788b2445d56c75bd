"""Operators over one global order against brute force, with values most rows share."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.operators.ordered import average_percent_ranked, dense_ranked, exact_quantiles, running_totals

VALUES = st.lists(st.sampled_from([0, 0, 0, 0, 1, 2, 2, 5, 9, -3]), min_size=1, max_size=40)
FEW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@FEW
@given(VALUES)
def test_running_totals(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id long, v double")
    got = {r["id"]: r for r in running_totals(df, [F.desc("v"), F.asc("id")], ["v"], partitions=5).collect()}
    prior = 0.0
    for i, v in sorted(enumerate(values), key=lambda p: (-p[1], p[0])):
        assert got[i]["prior_v"] == pytest.approx(prior)
        assert got[i]["total_v"] == pytest.approx(sum(values))
        prior += v


@FEW
@given(VALUES)
def test_ranks(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id long, v double")
    frame = pd.Series(values, dtype=float)
    pct = {r["id"]: r["p"] for r in average_percent_ranked(df, "v", "p").collect()}
    dense = {r["id"]: r["r"] for r in dense_ranked(df, "v", "r").collect()}
    for i, (p, r) in enumerate(zip(frame.rank(pct=True), frame.rank(method="dense", ascending=False))):
        assert pct[i] == pytest.approx(p)
        assert dense[i] == r


@FEW
@given(VALUES, VALUES)
def test_quantiles(spark, first, second):
    rows = [("a", float(v)) for v in first] + [("b", float(v)) for v in second]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"low": 0.1, "high": 0.975}).collect()}
    for g, values in (("a", first), ("b", second)):
        assert got[g]["low"] == pytest.approx(np.quantile(values, 0.1))
        assert got[g]["high"] == pytest.approx(np.quantile(values, 0.975))


def test_quantiles_without_groups_and_with_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,), (4.0,)], "v double")
    row = exact_quantiles(df, [], "v", {"m": 0.5, "q": 0.75}).first()
    assert (row["m"], row["q"]) == (2.0, 3.0)


def test_percent_rank_of_ties(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 2.0), (4, 3.0)], "id int, v double")
    assert sorted(r["p"] for r in average_percent_ranked(df, "v", "p").collect()) == [0.375, 0.375, 0.75, 1.0]
