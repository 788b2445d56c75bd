"""Quality rules, by injecting the defects they are there to find."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfline.operators import constraints, quality
from shelfline.operators.quality import QualityError


def test_missing_column_and_repeated_key(spark):
    with pytest.raises(QualityError, match="b"):
        quality.require_columns(["a"], ["a", "b"], "table")
    with pytest.raises(QualityError):
        quality.require_unique(spark.createDataFrame([(1,), (1,)], "id int"), ["id"])
    with pytest.raises(QualityError):
        quality.require_unique(spark.createDataFrame([(1,), (None,)], "id int"), ["id"])
    quality.require_unique(spark.createDataFrame([(1,), (2,)], "id int"), ["id"])


def sources(spark, **defects):
    day = dt.date(2020, 1, 1)
    series = [("i_s", "I", "D", "C", "S", defects.get("state", "CA"), 1, defects.get("units", 2))]
    wide = spark.createDataFrame(series * defects.get("copies", 1), "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d_1 int, d_2 int")
    days = [(day, 1000, "d_1"), (defects.get("second", dt.date(2020, 1, 2)), 1000, "d_2")]
    calendar = spark.createDataFrame(days, "date date, wm_yr_wk int, d string")
    for c in ("snap_CA", "snap_TX", "snap_WI"):
        calendar = calendar.withColumn(c, F.lit(0))
    for c in ("event_name_1", "event_type_1", "event_name_2", "event_type_2"):
        calendar = calendar.withColumn(c, F.lit(None).cast("string"))
    prices = spark.createDataFrame([("S", "I", 1000, defects.get("price", 2.0))], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    return wide, calendar, prices


def test_sound_sources_pass(spark):
    quality.validate_panel_sources(*sources(spark))


@pytest.mark.parametrize("defect, rule", [
    ({"copies": 2}, "duplicate_series"), ({"second": dt.date(2020, 1, 1)}, "duplicate_date"), ({"price": -1.0}, "invalid_price"),
    ({"units": -1}, "invalid_demand"), ({"units": None}, "invalid_demand"), ({"state": "NY"}, "invalid_identity"),
])
def test_source_defects(spark, defect, rule):
    with pytest.raises(QualityError, match=rule):
        quality.validate_panel_sources(*sources(spark, **defect))


def test_panel_defects(one_series):
    sound = one_series([1, 0, 2])
    quality.validate_panel(sound)
    with pytest.raises(QualityError, match="gap_in_history"):
        quality.validate_panel(sound.filter("date <> '2020-01-02'"))
    with pytest.raises(QualityError, match="repeated_day"):
        quality.validate_panel(sound.union(sound))
    with pytest.raises(QualityError, match="sold_without_price"):
        quality.validate_panel(sound.withColumn("sell_price", F.lit(None).cast("double")))
    with pytest.raises(QualityError, match="needs 4 days"):
        quality.require_history(sound, 4)


def test_profile_finds_outliers_duplicates_and_dates(spark):
    rows = [(float(i), "2020-01-01", "a@x") for i in range(10)] + [(1000.0, "bad", None), (1000.0, "bad", None)]
    df = spark.createDataFrame(rows, "amount double, order_date string, email string")
    got = {r["column_name"]: r for r in quality.table_profile(df).collect()}
    assert got["amount"]["rows"] == 12 and got["amount"]["duplicate_rows"] == 1
    assert got["amount"]["outliers_iqr"] == 2 and got["amount"]["maximum"] == 1000.0 and got["amount"]["zero"] == 1
    assert got["order_date"]["invalid_dates"] == 2 and got["order_date"]["date_min"] == dt.date(2020, 1, 1)
    assert got["email"]["missing"] == 2 and got["email"]["minimum"] is None and got["email"]["unique_values"] == 1


def test_repeated_rows_are_compared_whole(spark, monkeypatch):
    rows = [(1, "a", None), (1, "a", None), (1, "a", None), (None, "a", 1), (1, None, None), (2, None, None), (2, None, None)]
    df = spark.createDataFrame(rows, "k int, v string, w int")
    count = lambda: quality.repeated_rows(df, df.columns).first()["duplicate_rows"]
    assert count() == 3
    monkeypatch.setattr(quality.F, "xxhash64", lambda *_: F.lit(0).cast("long"))  # all digests collide
    assert count() == 3
    assert quality.repeated_rows(df.limit(0), df.columns).first()["duplicate_rows"] == 0


def test_profile_of_an_empty_table(spark):
    got = {r["column_name"]: r for r in quality.table_profile(spark.createDataFrame([], "a int, day_date string")).collect()}
    assert (got["a"]["rows"], got["a"]["duplicate_rows"], got["a"]["missing"], got["a"]["negative"], got["a"]["unique_values"]) == (0, 0, 0, 0, 0)
    assert got["a"]["minimum"] is None and got["a"]["invalid_dates"] is None and got["day_date"]["invalid_dates"] == 0


def test_rules_are_counted_by_the_job_that_writes(spark):
    df = spark.range(100).withColumn("units", F.when(F.col("id") % 10 == 3, F.lit(-1)).otherwise(F.col("id")))
    watch = quality.Watch(df, {"negative": "units < 0", "missing": "units IS NULL"})
    assert quality.materialize(watch.table, "watched").count() == 100
    assert watch.counts == {"negative": 10, "missing": 0}
    assert sorted(map(tuple, watch.report(spark).collect())) == [("missing", 0), ("negative", 10)]
    with pytest.raises(QualityError, match="negative"):
        watch.require_none("table")
    with pytest.raises(QualityError, match="short: negative"):
        quality.checked_table(df, "short", {"negative": "units < 0"})
    assert quality.checked_table(df.filter("units >= 0"), "sound", {"negative": "units < 0"}).count() == 90
    assert quality.checked_table(df.limit(0), "empty", {"negative": "units < 0"}).count() == 0


def test_keys_of_several_tables_in_one_job(spark):
    one, two = spark.createDataFrame([(1,), (1,), (None,)], "k int"), spark.createDataFrame([(1,), (2,)], "k int")
    counts = quality.key_rule_counts({"one": (one, ["k"]), "two": (two, ["k"])})
    assert sorted(map(tuple, counts.collect())) == [("one", 2), ("two", 0)]
    with pytest.raises(QualityError, match="keys: one$"):
        quality.require_no_failures(counts, "keys")


def test_constraints_count_violations(spark):
    lines = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "order_item_id string, order_id long")
    delivery = spark.createDataFrame([(1, 1, 0.0), (2, 5, -1.0)], "order_id long, late_order int, positive_delay_days double")
    got = {r["test"]: r["failures"] for r in constraints.constraint_counts({"lines": lines, "delivery": delivery}).collect()}
    assert got == {"lines_key": 1, "lines_order_id_reference": 1, "delivery_key": 0, "delivery_late_flag": 1, "delivery_delay": 1}


def test_a_join_that_stops_at_a_repeated_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, 10), (2, None)], "k int, w int")
    joined = quality.many_to_one(left, right, ["k"], "right", "left")
    assert sorted(map(tuple, joined.collect())) == [(1, "a", 10), (2, "b", None), (3, "c", None)]
    again = right.unionByName(spark.createDataFrame([(1, 11)], "k int, w int"))
    with pytest.raises(PySparkException, match="right: null or repeated key"):
        quality.many_to_one(left, again, ["k"], "right").count()
    unknown = right.unionByName(spark.createDataFrame([(None, 1)], "k int, w int"))
    assert quality.many_to_one(left, unknown, ["k"], "right").count() == 2  # a null meets no row
    with pytest.raises(PySparkException, match="null or repeated key"):
        quality.one_row_each(unknown, ["k"]).collect()


def test_long_keys_are_counted_by_their_digests(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", "y"), (None, None), (None, None), ("", "x"), (None, "x")], "k string, l string")
    for keys in (["k"], ["k", "l"]):
        digests = quality.unique_text_violations(rows, keys)
        assert sorted(r.rows for r in digests.collect()) == sorted(r.rows for r in quality.unique_key_violations(rows, keys).collect())
    key = next(c for c in constraints.CONSTRAINTS if c.name == "lines_key")
    plan = key.violations({"lines": rows.withColumnRenamed("k", "order_item_id")})._jdf.queryExecution().executedPlan().toString()
    shuffled = next(line for line in plan.splitlines() if "Exchange" in line)
    assert "_0" in shuffled and "order_item_id" not in shuffled
    empty = quality.unique_text_violations(rows.limit(0), ["k"])
    assert empty.isEmpty()


def test_the_date_span_reads_orders_not_lines(monkeypatch):
    from unittest.mock import MagicMock

    from shelfline.plans import kpi_queries

    monkeypatch.setattr(kpi_queries.dimensions, "dim_date", lambda calendar, orders: orders)
    monkeypatch.setattr(kpi_queries.marts, "shipping_mode_performance", lambda delivery: delivery)
    d = MagicMock()
    assert kpi_queries._tables(d)["dim_date"] is d.delivery
