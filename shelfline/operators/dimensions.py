"""Dimensions, the date-event bridge and the price fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.columns import date_key
from shelfline.operators.quality import key_rule_counts, require_no_failures


def distinct_of(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def event_pairs(calendar: DataFrame) -> DataFrame:
    """Both event slots of each day as (date, event_name, event_type)."""
    slots = [
        calendar.select("date", F.col(f"event_name_{i}").alias("event_name"), F.col(f"event_type_{i}").alias("event_type"))
        for i in (1, 2)
    ]
    return slots[0].union(slots[1]).filter("event_name IS NOT NULL").distinct()


def dim_event(calendar: DataFrame) -> DataFrame:
    return event_pairs(calendar).select("event_name", "event_type").distinct()


def bridge_date_event(calendar: DataFrame) -> DataFrame:
    return event_pairs(calendar).select(date_key("date").alias("date_key"), "event_name").distinct()


def fact_sell_price(sales: DataFrame) -> DataFrame:
    return sales.filter("sell_price IS NOT NULL").select("item_id", "store_id", "wm_yr_wk", "sell_price").distinct()


def date_spine(spark: SparkSession, lo: dt.date, hi: dt.date) -> DataFrame:
    """Every day from lo to hi with its calendar fields."""
    days = spark.range(0, (hi - lo).days + 1, 1, 1).select(F.date_add(F.lit(lo), F.col("id").cast("int")).alias("date"))
    return days.select(
        "date", date_key("date").alias("date_key"), F.year("date").alias("year"), F.month("date").alias("month"),
        F.quarter("date").alias("quarter"),
    )


def dim_date(calendar: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per day over the span of both domains."""
    spans = [
        df.agg(F.min(c).cast("date").alias("lo"), F.max(c).cast("date").alias("hi"))
        for df, c in ((calendar, "date"), (lines, "order_date"))
    ]
    lo, hi = spans[0].union(spans[1]).agg(F.min("lo"), F.max("hi")).first()
    return date_spine(calendar.sparkSession, lo, hi)


def panel_dimensions(sales: DataFrame, calendar: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_product": distinct_of(sales, "item_id", "department_id", "category_id"),
        "dim_store": distinct_of(sales, "store_id", "state_id"),
        "dim_state": distinct_of(sales, "state_id"),
        "dim_category": distinct_of(sales, "category_id"),
        "dim_department": distinct_of(sales, "department_id", "category_id"),
        "dim_event": dim_event(calendar),
        "bridge_date_event": bridge_date_event(calendar),
        "fact_sell_price": fact_sell_price(sales),
    }


def order_dimensions(lines: DataFrame) -> dict[str, DataFrame]:
    names = {
        "dim_product_category": "category", "dim_market": "market", "dim_region": "region",
        "dim_shipping_mode": "shipping_mode", "dim_customer_segment": "customer_segment",
    }
    return {name: distinct_of(lines, column) for name, column in names.items()}


def all_dimensions(sales: DataFrame, calendar: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    """Every dimension, its first column checked to be a key. The order date is the date dimension
    in a second role."""
    dims = {**panel_dimensions(sales, calendar), **order_dimensions(lines)}
    dims["dim_date"] = dims["dim_order_date"] = dim_date(calendar, lines)
    keyed = {name: (df, df.columns[:1]) for name, df in dims.items() if name.startswith("dim_") and name != "dim_order_date"}
    require_no_failures(key_rule_counts(keyed), "dimensions with a null or repeated key")
    return dims
