"""Order lines: typing, flags, conflicts and the interactive cohort."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfline.operators import orders
from shelfline.operators.quality import QualityError
from shelfline.plans import kpi_queries
from shelfline.plans.data import Data
from shelfline.session import is_stored
from shelfline.settings import Settings
from shelfline.sources import testdata
from shelfline.sources.readers import admit_order_columns, cohort_lines, unique_lines
from tests.conftest import SMALL

SCHEMA = (
    "order_id long, order_item_id string, order_date_dateorders string, shipping_date_dateorders string, days_for_shipping_real string, "
    "days_for_shipment_scheduled string, shipping_mode string, market string, order_status string, order_item_quantity string, "
    "order_item_total string, benefit_per_order string"
)


def line(**changes):
    row = dict(order_id=1, order_item_id="a", order_date_dateorders="1/31/2018 22:56", shipping_date_dateorders="2018-02-03",
               days_for_shipping_real="3", days_for_shipment_scheduled="2", shipping_mode=" First Class ", market="EU",
               order_status="Complete", order_item_quantity="1", order_item_total="10.0", benefit_per_order="2.5")
    return {**row, **changes}


def cleaned(spark, *changes, **options):
    rows = [tuple(line(**c).values()) for c in changes]
    return orders.clean_lines(spark.createDataFrame(rows, SCHEMA), **options)


def test_types_and_labels(spark):
    row = cleaned(spark, {}, mapping={"eu": "europe"}).first()
    assert row["order_date"] == dt.date(2018, 1, 31) and row["shipping_date"] == dt.date(2018, 2, 3) and row["date_key"] == 20180131
    assert (row["shipping_mode"], row["market"], row["category"]) == ("first class", "europe", "unknown")
    assert (row["delay_days"], row["late_order"], row["positive_delay_days"]) == (1.0, 1, 1.0)
    assert row["profit_margin"] == 0.25 and not row["date_duration_mismatch"]


@pytest.mark.parametrize("text, date", [
    ("2018-01-31", dt.date(2018, 1, 31)), ("2018-01-31 05:06:07", dt.date(2018, 1, 31)), ("1/2/2018", dt.date(2018, 1, 2)),
    ("01/02/2018 23:59", dt.date(2018, 1, 2)), ("13/45/2018", None), ("soon", None), (None, None),
])
def test_dates(spark, text, date):
    assert cleaned(spark, {"shipping_date_dateorders": text}).first()["shipping_date"] == date


def test_flags_and_nulls(spark):
    negative, unknown, canceled, abnormal, zero = cleaned(
        spark, {"order_item_total": "-1", "order_item_id": "1"}, {"benefit_per_order": "n/a", "days_for_shipping_real": "", "order_item_id": "2"},
        {"order_status": "CANCELED", "order_item_id": "3"}, {"benefit_per_order": "-21", "order_item_id": "4"},
        {"order_item_total": "0", "order_item_id": "5"},
    ).orderBy("order_item_id").collect()
    assert negative["invalid_sales_flag"]
    assert unknown["profit"] is None and not unknown["abnormal_profit_flag"] and not unknown["loss_making_line"]
    assert not unknown["delivery_eligible"] and unknown["late_order"] is None and not unknown["date_duration_mismatch"]
    assert not canceled["delivery_eligible"] and canceled["positive_delay_days"] is None
    assert abnormal["abnormal_profit_flag"] and abnormal["loss_making_line"]
    assert zero["profit_margin"] is None


def test_absent_profit_column(spark):
    raw = spark.createDataFrame([tuple(line().values())], SCHEMA).drop("benefit_per_order")
    row = orders.clean_lines(raw).first()
    assert row["profit"] is None and row["profit_margin"] is None
    assert orders.profit_summary(orders.line_facts(orders.clean_lines(raw))).filter("profit IS NOT NULL").count() == 0


def test_conflicting_order_is_rejected(spark):
    rows = [tuple(line(order_item_id=i, days_for_shipping_real=d).values()) for i, d in (("a", "3"), ("b", "80"))]
    with pytest.raises(QualityError, match="conflicting"):
        orders.transform_orders(spark.createDataFrame(rows, SCHEMA))
    null_and_value = [tuple(line(order_item_id=i, days_for_shipping_real=d).values()) for i, d in (("a", "3"), ("b", None))]
    with pytest.raises(QualityError, match="conflicting"):
        orders.transform_orders(spark.createDataFrame(null_and_value, SCHEMA))


@pytest.mark.parametrize("change, message", [
    ({"order_date_dateorders": "never"}, "order date"), ({"order_id": None}, "without an order id"),
])
def test_rejected_lines(spark, change, message):
    with pytest.raises(QualityError, match=message):
        orders.transform_orders(spark.createDataFrame([tuple(line(**change).values())], SCHEMA))


def test_whole_source(spark, data):
    raw, dropped = admit_order_columns(data.raw_lines)
    assert dropped == ["customer_fname"]
    lines, delivery = orders.transform_orders(raw, Settings())
    total = testdata.table(spark, SMALL, "lineitem").count()
    assert lines.count() == total > delivery.count()
    assert delivery.select("order_id").distinct().count() == delivery.count()
    sums = lines.agg(F.sum("sales"), F.sum("profit")).first()
    source = raw.agg(F.sum("order_item_total"), F.sum("benefit_per_order")).first()
    assert list(sums) == pytest.approx(list(source))
    assert not any("customer_fname" in c or "email" in c for c in lines.columns)


def cohort(spark, data):
    raw = data.raw_lines.withColumn("Benefit per order", F.coalesce("Benefit per order", F.lit(0.0)))
    return cohort_lines(raw).withColumn("order_date", orders.parsed_date_of("order_date"))


def test_cohort_filters(spark, data):
    lines = cohort(spark, data)
    everything = orders.analyze_cohort(lines)
    europe = orders.analyze_cohort(lines, market="EUROPE", month="all")
    whole, part = everything["metrics"].first(), europe["metrics"].first()
    assert part["orders"] < whole["orders"]
    assert everything["categories"].agg(F.sum("revenue")).first()[0] == pytest.approx(whole["revenue"], abs=0.02)
    with pytest.raises(ValueError, match="unsupported market"):
        orders.analyze_cohort(lines, market="ATLANTIS")


def test_cohort_rejects_inconsistent_shipping(spark):
    rows = [(1, "a", "EU", "B", "c", dt.date(2020, 1, 1), 1.0, 2.0, 1.0, 1.0, 1.0), (1, "b", "EU", "B", "c", dt.date(2020, 1, 1), 2.0, 2.0, 1.0, 1.0, 1.0)]
    lines = spark.createDataFrame(rows, "order_id long, order_item_id string, market string, segment string, category string, order_date date, "
                                        "actual_days double, scheduled_days double, quantity double, revenue double, profit double")
    for table in orders.analyze_cohort(lines).values():  # no path skips the check
        with pytest.raises(PySparkException, match="inconsistent shipping"):
            table.collect()
    agreed = lines.withColumn("actual_days", F.when(F.col("order_item_id") == "a", F.col("actual_days")))
    assert orders.analyze_cohort(agreed)["metrics"].first()["orders"] == 1


def test_deliveries_come_from_orders_without_their_lines(spark, data, tmp_path):
    """An order has a delivery if one of its lines has a known part; the lines themselves are not read back for it."""
    folder = str(tmp_path)
    for name in ("orders", "lineitem", "customer", "nation", "region", "part"):
        testdata.table(spark, SMALL, name).write.parquet(f"{folder}/{name}.parquet")
    keys = [r[0] for r in testdata.table(spark, SMALL, "lineitem").select("l_orderkey").distinct().orderBy("l_orderkey").limit(3).collect()]
    first, second, third = (F.col("l_orderkey") == k for k in keys)
    lost = testdata.table(spark, SMALL, "lineitem").withColumn(
        "l_partkey", F.when(first, F.lit(-5).cast("long")).when(second, F.lit(None).cast("long")).when(
            third & (F.col("l_linenumber") > 1), F.lit(-7).cast("long")).otherwise(F.col("l_partkey")))
    lost.write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    own = Data(spark, folder)
    expected = orders.one_row_per_order(own.cleaned)
    assert expected.filter(F.col("order_id").isin(*keys[:2])).count() == 0
    assert own.delivery.exceptAll(expected).count() == expected.exceptAll(own.delivery).count() == 0
    assert not is_stored(own.cleaned)
    conflicting = testdata.table(spark, SMALL, "orders").withColumn("o_orderpriority", F.lit("1-URGENT")).filter("o_orderkey % 7 = 0")
    conflicting.write.mode("append").parquet(f"{folder}/orders.parquet")
    with pytest.raises(QualityError, match="conflicting values"):
        Data(spark, folder).delivery


def test_line_keys_are_checked_on_stored_lines(spark):
    lines = spark.createDataFrame([("a",), ("b",)], "order_item_id string")
    assert unique_lines(lines) is lines
    for wrong in ("a", None):
        with pytest.raises(QualityError, match="repeated key"):
            unique_lines(lines.union(spark.createDataFrame([(wrong,)], "order_item_id string")))


def test_line_values_drop_and_repeat_lines_as_their_orders_do(spark, tmp_path):
    folder = str(tmp_path)
    for name in ("orders", "lineitem", "customer", "nation", "region", "part"):
        testdata.table(spark, SMALL, name).write.parquet(f"{folder}/{name}.parquet")
    headed, lined = testdata.table(spark, SMALL, "orders"), testdata.table(spark, SMALL, "lineitem")
    key = F.col("o_orderkey")
    stranger = F.when(key % 19 == 2, F.lit(-1).cast("long")).when(key % 23 == 4, F.lit(None).cast("long")).otherwise(F.col("o_custkey"))
    several = headed.filter(key % 13 != 1).withColumn("o_custkey", stranger)
    several.union(headed.filter(key % 17 == 3)).write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    lined.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 29 != 5, F.col("l_orderkey"))).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    testdata.table(spark, SMALL, "customer").filter("c_custkey % 7 = 0").write.mode("append").parquet(f"{folder}/customer.parquet")
    own = Data(spark, folder)
    columns = ["order_id", "order_item_id", "category", "product_name", "quantity", "sales", "profit", "invalid_sales_flag"]
    got, expected = own.line_values.select(columns), own.lines.select(columns)
    assert own.uneven_orders.filter("size(copies) > 1").count() and own.uneven_orders.filter("size(copies) = 0").count()
    assert got.exceptAll(expected).count() == expected.exceptAll(got).count() == 0 < got.count()
    summed = lambda df: {(r["dimension"], r["segment"]): [r["sales"], r["profit"], r["profit_margin"]] for r in df.collect()}
    got, expected = summed(orders.segment_profit(own.line_values, ("category", "product_name"))), summed(orders.profit_summary(own.lines))
    assert got.keys() == {k for k in expected if k[0] in ("category", "product_name")}
    for segment, sums in got.items():
        assert sums == pytest.approx(expected[segment])


def test_recommendations_take_no_line_to_its_order(data, monkeypatch):
    written = {}
    monkeypatch.setattr(kpi_queries, "materialize", lambda df, name: written.setdefault(name, df))
    kpi_queries._recommendations(data)
    plan = written["profit_summary"]._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" not in plan and "order_id" not in plan
