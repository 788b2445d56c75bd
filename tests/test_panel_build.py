"""The panel made of whole weeks against the one made day by day."""

from __future__ import annotations

import datetime as dt

from shelfline.operators import panel
from shelfline.sources import testdata

LO, HI = dt.date(2020, 12, 24), dt.date(2021, 1, 9)
SOLD = "item_id string, store_id string, item_no int, store_no int, date date, units long, quantity long, cents long"


def sold(spark):
    rows = [
        ("ITEM_000001", "S_0", 1, 0, LO, 2, 4, 400), ("ITEM_000001", "S_0", 1, 0, HI, 1, 1, 90),
        ("ITEM_000001", "S_0", 1, 0, dt.date(2021, 1, 1), 5, 6, 660), ("ITEM_000002", "S_1", 2, 1, dt.date(2020, 12, 31), 3, 3, 333),
        ("ITEM_000002", "S_2", 2, 2, None, 3, 3, 333), (None, "S_2", None, 2, LO, 4, 4, 100), ("ITEM_000003", None, 3, None, HI, 4, 4, 100)]
    return spark.createDataFrame(rows, SOLD)


def both(spark):
    rows = sold(spark)
    calendar = spark.createDataFrame(
        [(LO + dt.timedelta(days=i), i // 7 + 1000, f"d_{i + 1}", i % 2, 1, 0, "E" if i == 8 else None, None, None, None)
         for i in range((HI - LO).days + 1)],
        "date date, wm_yr_wk int, d string, snap_CA int, snap_TX int, snap_WI int, event_name_1 string, event_type_1 string, "
        "event_name_2 string, event_type_2 string")
    prices = testdata.prices(rows, LO, HI)
    by_week = panel.build_sales(testdata.priced_demand(rows, prices, LO, HI), calendar)
    return by_week, panel.build_sales(testdata.demand(rows, LO, HI), calendar, prices)


def test_weeks_give_the_days_that_day_by_day_joins_give(spark):
    by_week, by_day = both(spark)
    assert by_week.columns == by_day.columns and by_week.count() == by_day.count() == 5 * 17
    assert by_week.exceptAll(by_day).isEmpty() and by_day.exceptAll(by_week).isEmpty()


def test_days_are_not_shuffled(spark):
    """Nothing but broadcasts above the step that makes days of weeks."""
    by_week, _ = both(spark)
    plan = by_week._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("posexplode")]
    assert "Exchange" not in above.replace("BroadcastExchange", "")


def test_lines_meet_their_store_before_they_are_shuffled(spark):
    """Two shuffles of lines, by order and by item, store and date."""
    plan = testdata.sold(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
