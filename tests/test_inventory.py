"""Policy formulas and the replay, the latter against a plain loop."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfline.functions.columns import normal_cdf, normal_quantile
from shelfline.operators import policy, replay
from shelfline.operators.quality import QualityError


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_safety_stock(spark):
    z = normal_quantile(0.95)
    got = value(spark, policy.safety_stock(F.lit(10.0), F.lit(3.0), F.lit(7.0), F.lit(2.0), F.lit(z)))
    assert got == pytest.approx(z * math.sqrt(7 * 9 + 100 * 4))


@pytest.mark.parametrize("level", [0, 1, -0.1, 1.1])
def test_service_level_range(level):
    with pytest.raises(QualityError):
        policy.require_service_levels([level])


def test_order_quantities(spark):
    assert value(spark, policy.economic_quantity(F.lit(1200.0), F.lit(25.0), F.lit(3.0))) == pytest.approx(math.sqrt(20000))
    assert value(spark, policy.round_to_lots(F.lit(7.0), F.lit(6.0), F.lit(6.0))) == 12
    assert value(spark, policy.round_to_lots(F.lit(0.0), F.lit(6.0), F.lit(6.0))) == 0
    assert value(spark, policy.round_to_lots(F.lit(2.0), F.lit(10.0), F.lit(6.0))) == 12


def test_normal_cdf(spark):
    from statistics import NormalDist

    points = [-40.0, -8.0, -7.1, -7.0, -1.5, 0.0, 0.3, 2.0, 7.05, 7.08, 9.0, 40.0]
    df = spark.createDataFrame([(x,) for x in points], "x double")
    for r in df.select("x", normal_cdf("x").alias("p")).collect():
        assert r["p"] == pytest.approx(NormalDist().cdf(r["x"]), abs=1e-15)


def test_stockout_without_spread(spark):
    p = lambda stock: value(spark, policy.stockout_probability(F.lit(stock), F.lit(5.0), F.lit(0.0)))
    assert (p(4.0), p(5.0), p(6.0)) == (1.0, 0.0, 0.0)


def test_recorded_lead_times(spark):
    """Against the formulas in plain Python; planted: a slow series with many durations, one with a single one."""
    days = {("slow", "s"): [20, 22, 24] * 40, ("fast", "s"): [2, 3, 4, 3], ("one", "s"): [30], ("other", "t"): [3, 5] * 10}
    rows = [(i, s, d, 1) for (i, s), ds in days.items() for d in ds] + [
        ("fast", "s", -1, 9), ("fast", "s", None, 9), ("fast", "s", 91, 9), ("gone", "s", 95, 3), ("gone", "s", 5, 0)]
    schema = "item_id string, store_id string, days int, lines long"
    got = {(r.item_id, r.store_id): r for r in policy.recorded_lead_times(spark.createDataFrame(rows, schema)).collect()}
    assert got.keys() == days.keys()
    every = [d for ds in days.values() for d in ds]
    mean = lambda xs: sum(xs) / len(xs)
    inner = {k: sum((d - mean(ds)) ** 2 for d in ds) for k, ds in days.items()}
    inside = sum(inner.values()) / (len(every) - len(days))
    outer = sum(len(ds) * (mean(ds) - mean(every)) ** 2 for ds in days.values())
    between = (outer - (len(days) - 1) * inside) / (len(every) - sum(len(ds) ** 2 for ds in days.values()) / len(every))
    for key, ds in days.items():
        weight = len(ds) * between / (len(ds) * between + inside)
        assert got[key].recorded_durations == len(ds)
        assert got[key].average_lead_time_days == pytest.approx(weight * mean(ds) + (1 - weight) * mean(every))
        assert got[key].lead_time_standard_deviation == pytest.approx(math.sqrt((inner[key] + 5 * inside) / (len(ds) + 4)))
    # Lines with the same days in one row count as many.
    counted = [(i, s, d, ds.count(d)) for (i, s), ds in days.items() for d in set(ds)]
    again = {(r.item_id, r.store_id): r for r in policy.recorded_lead_times(spark.createDataFrame(counted, schema)).collect()}
    assert again == got


@pytest.mark.parametrize("days, expected", [([], []), ([4, 4, 4], [4.0]), ([7], [7.0])])
def test_lead_times_without_spread(spark, days, expected):
    rows = spark.createDataFrame([("a", "s", d, 1) for d in days], "item_id string, store_id string, days int, lines long")
    got = policy.recorded_lead_times(rows).collect()
    assert [r.average_lead_time_days for r in got] == expected
    assert [r.lead_time_standard_deviation for r in got] == [0.0] * len(expected)


def test_override_keeps_other_cells(spark):
    base = spark.createDataFrame([("a", "s", 1.0, 2.0), ("b", "s", 3.0, 4.0)], "item_id string, store_id string, x double, y double")
    given = spark.createDataFrame([("a", "s", 9.0, None)], "item_id string, store_id string, x double, y double")
    assert [tuple(r)[2:] for r in policy.override(base, given).orderBy("item_id").collect()] == [(9.0, 2.0), (3.0, 4.0)]
    with pytest.raises(QualityError):
        policy.override(base, given.union(given))


PARAMETERS = dict(
    initial_inventory=10.0, average_daily_demand=5.0, average_lead_time_days=2.0, lead_time_standard_deviation=0.0,
    review_period_days=1.0, minimum_order_quantity=6.0, case_pack_size=6.0, eoq=12.0, protection_safety_stock=4.0,
    estimated_unit_cost=2.0, annual_holding_cost_rate=0.25, ordering_cost_per_order=10.0, lost_sale_penalty=3.0, last_price=4.0,
)


def run(spark, demand, forecast, draws, **changes):
    p = {**PARAMETERS, **changes}
    start = dt.date(2020, 1, 1)
    window = spark.createDataFrame(
        [("I", "S", start + dt.timedelta(days=i), float(d), float(f)) for i, (d, f) in enumerate(zip(demand, forecast))],
        "item_id string, store_id string, date date, actual_units double, forecast_units double")
    policies = spark.createDataFrame(
        [("I", "S", 0.95, *p.values())],
        "item_id string, store_id string, target_service_level double, " + ", ".join(f"{c} double" for c in p))
    lead = spark.createDataFrame([("I", "S", 0, i, float(z)) for i, z in enumerate(draws)],
                                 "item_id string, store_id string, run_id int, day int, z double")
    ledger = replay.replay(window, policies, lead)
    return p, {name: ledger.filter(F.col("policy") == name).orderBy("date").collect() for name in replay.POLICIES}, ledger


def loop(demand, forecast, draws, p, name):
    """The same days one after the other."""
    stock, open_orders, loss, started, out = p["initial_inventory"], [], False, False, []
    lots = lambda q: math.ceil(max(q, p["minimum_order_quantity"]) / p["case_pack_size"]) * p["case_pack_size"] if q > 0 else 0.0
    ahead = math.ceil(p["average_lead_time_days"] + p["review_period_days"])
    for day, need in enumerate(demand):
        came = sum(q for t, q in open_orders if t == day)
        completed = came > 0 and started
        successful = completed and not loss
        if came > 0:
            loss, started = False, True
        open_orders = [(t, q) for t, q in open_orders if t > day]
        stock += came
        served = min(stock, need)
        stock -= served
        loss = loss or need > served
        position = stock + sum(q for _, q in open_orders)
        order = 0.0
        if day % int(p["review_period_days"]) == 0:
            if name == "baseline":
                order = lots(p["average_daily_demand"] * 14 - position)
            else:
                future = forecast[day + 1:day + 1 + ahead]
                target = sum(future) + (ahead - len(future)) * forecast[-1] + p["protection_safety_stock"]
                if position < target:
                    order = lots(max(p["eoq"], target - position))
        if order:
            lead = max(1, round(p["average_lead_time_days"] + p["lead_time_standard_deviation"] * draws[day]))
            open_orders.append((day + lead, order))
        out.append((came, served, need - served, order, sum(q for _, q in open_orders), stock, int(completed), int(successful)))
    return out


FIELDS = ("arrivals", "fulfilled_units", "lost_sales_units", "order_quantity", "in_transit_units", "closing_inventory",
          "completed_cycles", "successful_cycles")


def test_ledger_identities(spark):
    _, ledgers, frame = run(spark, [5] * 10, [5] * 10, [0] * 10)
    for rows in ledgers.values():
        for r in rows:
            assert r["opening_inventory"] + r["arrivals"] - r["fulfilled_units"] == pytest.approx(r["closing_inventory"])
            assert r["actual_demand"] == r["fulfilled_units"] + r["lost_sales_units"]
            assert r["order_quantity"] % 6 == 0
        assert rows[0]["arrivals"] == rows[1]["arrivals"] == 0
    for r in replay.ledger_kpis(frame).collect():
        assert 0 <= r["fill_rate"] <= 1 and r["days"] == 10
        if r["policy"] == "baseline":
            assert r["estimated_cost_reduction"] == 0


@pytest.mark.parametrize("changes", [{}, {"review_period_days": 3.0, "lead_time_standard_deviation": 1.5},
                                     {"average_lead_time_days": 5.5, "initial_inventory": 0.0, "eoq": 1.0}])
def test_replay_equals_a_loop(spark, changes):
    import random

    rng = random.Random(7)
    demand = [rng.choice([0, 0, 3, 5, 9, 14]) for _ in range(28)]
    forecast = [round(rng.uniform(0, 9), 3) for _ in range(28)]
    draws = [rng.gauss(0, 1) for _ in range(28)]
    p, ledgers, _ = run(spark, demand, forecast, draws, **changes)
    for name, rows in ledgers.items():
        for got, want in zip(rows, loop(demand, forecast, draws, p, name), strict=True):
            assert [got[f] for f in FIELDS] == pytest.approx(list(want))


def test_reorder_point_and_grid(data):
    off = data.policy.filter("abs(reorder_point - expected_lead_time_demand - safety_stock) > 1e-8")
    assert off.count() == 0
    assert len(policy.sensitivity_cases()) == 13
