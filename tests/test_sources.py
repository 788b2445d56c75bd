"""Readers and writers on real files."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfline.operators import panel, quality
from shelfline.plans import kpis, marts
from shelfline.sources import readers, schemas, sinks, testdata


def write(path, text):
    path.write_text(text)
    return path


CALENDAR = "date,wm_yr_wk,weekday,d,event_name_1,event_type_1,event_name_2,event_type_2,snap_CA,snap_TX,snap_WI\n" \
           "2020-01-01,1,Wed,d_1,Fest,Cultural,,,1,0,0\n2020-01-02,1,Thu,d_2,,,,,0,0,0\n"
PRICES = "store_id,item_id,wm_yr_wk,sell_price\nS,I,1,2.5\n"
WIDE = "id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2\nI_S,I,D,C,S,CA,{},3\n"


def folder(tmp_path, *sales):
    write(tmp_path / "calendar.csv", CALENDAR)
    write(tmp_path / "sell_prices.csv", PRICES)
    for name, units in sales:
        write(tmp_path / name, WIDE.format(units))
    return str(tmp_path)


def test_panel_from_csv(spark, tmp_path):
    wide, calendar, prices = readers.read_panel(spark, folder(tmp_path, ("sales_train_validation.csv", 0), ("sales_train_evaluation.csv", 1)))
    quality.validate_panel_sources(wide, calendar, prices)
    sales = panel.build_sales(panel.unpivot_days(wide), calendar, prices)
    rows = sales.orderBy("date").collect()
    assert [r["units_sold"] for r in rows] == [1, 3] and [r["revenue"] for r in rows] == [2.5, 7.5]
    assert rows[0]["snap_flag"] == 1 and rows[0]["event_flag"] == 1 and rows[1]["event_flag"] == 0 and rows[0]["weekday"] == 3
    assert set(sales.columns) == set(schemas.SALES.names)


def test_validation_file_is_the_fallback(spark, tmp_path):
    path = folder(tmp_path, ("sales_train_validation.csv", 0))
    assert readers.choose_sales_file(spark, path).endswith("validation.csv")
    with pytest.raises(FileNotFoundError):
        readers.choose_sales_file(spark, str(tmp_path / "nowhere"))


def test_revenue_is_zero_without_sales_and_price(spark):
    df = spark.createDataFrame([(0, None), (2, 1.5), (2, None)], "u long, p double")
    assert [r[0] for r in df.select(panel.revenue_of(F.col("u"), F.col("p"))).collect()] == [0.0, 3.0, None]


def test_order_csv_keeps_admitted_columns_only(spark, tmp_path):
    path = write(tmp_path / "orders.csv", "Order Id,Order Item Id,order date (DateOrders),Customer Email,Shipping Mode\n1,7,1/31/2018 22:56,x@y, First Class \n")
    lines, dropped = readers.read_order_lines(spark, str(path))
    assert dropped == ["customer_email"] and set(lines.columns) == {"order_id", "order_item_id", "order_date_dateorders", "shipping_mode"}
    assert lines.first()["shipping_mode"] == "First Class"


def test_colliding_headers(spark):
    df = spark.createDataFrame([(1, 2)], ["Order Id", "order_id"])
    with pytest.raises(ValueError, match="same normalised name"):
        readers.admit_order_columns(df)


def test_cohort_lines_reject_bad_numbers(spark, data):
    with pytest.raises(PySparkException, match="non-finite"):
        readers.cohort_lines(data.raw_lines).count()  # some lines have no profit
    assert readers.cohort_lines(data.raw_lines, unknown=("profit",)).count() == data.raw_lines.count()
    for wrong in ("NaN", "Infinity", "much"):
        spoilt = data.raw_lines.withColumn("Benefit per order", F.lit(wrong))
        with pytest.raises(PySparkException, match="non-finite"):
            readers.cohort_lines(spoilt, unknown=("profit",)).count()
    with pytest.raises(PySparkException, match="repeated key"):
        readers.cohort_lines(data.raw_lines.union(data.raw_lines.limit(1)), unknown=("profit",)).count()


def test_wide_and_long_agree(data):
    long = panel.unpivot_days(data.wide).select("id", "d", "units_sold")
    assert long.exceptAll(data.demand.select("id", "d", "units_sold")).count() == 0


def test_partitioned_write_prunes(spark, data, tmp_path):
    path = str(tmp_path / "sales")
    sinks.write_partitioned(data.sales, path)
    sinks.write_partitioned(data.sales, path)  # a second run replaces the first
    back = readers.scan(spark, path)
    assert back.count() == data.sales.count()
    plan = back.filter("year = 2000 AND store_id = 'S_1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert (tmp_path / "sales" / "store_id=S_1" / "year=2000").is_dir()


def test_export_and_json(spark, data, tmp_path):
    monthly = panel.sales_by(data.sales, panel.month_start("date"))
    sinks.export(monthly, "monthly", str(tmp_path))
    exports = readers.read_exports(spark, str(tmp_path), ["monthly"])
    csv = readers.read_csv(spark, str(tmp_path / "monthly.csv"))
    assert exports["monthly"].count() == csv.count() == monthly.count()
    sinks.write_json(quality.rule_counts(quality.panel_rules(data.sales)), str(tmp_path / "rules"))
    text = "".join(p.read_text() for p in (tmp_path / "rules").glob("*.json"))
    assert all(json.loads(row)["failures"] == 0 for row in text.splitlines())


def test_serving_load_keeps_target_columns(spark, data):
    frames = {"panel.fact_sales_daily": data.sales, "orders.fact_delivery_performance": data.delivery,
              "common.dim_date": data.calendar.withColumn("date_key", F.lit(1))}
    for _ in range(2):
        assert set(sinks.load_serving(spark, frames)) == set(frames)
    served = spark.table("panel.fact_sales_daily")
    assert served.columns == schemas.SERVING["panel.fact_sales_daily"].names and served.count() == data.sales.count()
    assert spark.table("common.dim_date").filter("quarter IS NOT NULL").count() == 0


def test_monthly_refresh_and_metadata(spark, data):
    products = data.sales.select("item_id", "category_id").distinct()
    stores = data.sales.select("store_id", "state_id").distinct()
    mart = marts.sales_performance(data.sales, products, stores)
    sinks.refresh_monthly_sales(mart)
    assert spark.table("mart.mv_monthly_sales").count() == mart.count()
    row = kpis.last_refresh(sinks.run_metadata(spark, "test", "full")).first()
    assert row["last_refresh"] is not None
