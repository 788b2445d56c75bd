"""Adapters: the driver's star-schema tables as the panel and order-line sources.

Both adapters read whole tables. Demand is counted on order dates; an item gathers the parts of a
number range, wide ranges for three parts in four, so that a few items hold most of the demand.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import materialize

FUTURE_DAYS = 28
RANGE_DAYS = 1 << 18
"""Days of series that one task of `priced_demand` makes."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def hundredths(name: str) -> Column:
    """A non-negative amount with two decimals as a whole number; `round` goes through decimals."""
    return F.floor(F.col(name) * 100 + 0.5)


def date_range(spark: SparkSession, folder: str) -> tuple[dt.date, dt.date]:
    lo, hi = table(spark, folder, "orders").agg(
        F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")
    ).first()
    return lo, hi


def order_peaks(spark: SparkSession, folder: str) -> DataFrame:
    """Days with far more orders than usual, with their most and second most frequent priority."""
    per_priority = table(spark, folder, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date"), "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct(-F.col("n"), "o_orderpriority")))["o_orderpriority"]  # a handful of priorities
    days = per_priority.groupBy("date").agg(F.sum("n").alias("n"), ranked.alias("names"))
    usual = days.agg((F.avg("n") + 1.5 * F.stddev_samp("n")).alias("bound")).select("bound").scalar()
    return days.filter(F.col("n") > usual).select("date", F.get("names", F.lit(0)).alias("leading"), F.get("names", F.lit(1)).alias("second"))


def calendar(spark: SparkSession, folder: str, lo: dt.date, hi: dt.date) -> DataFrame:
    """One row per day, with the days to forecast after the last day of history. Its events are the peaks of the order table:
    the leading priority in the first slot, the second in the other. A priority's type goes by its name, whichever slot it takes."""
    days = (hi - lo).days + 1 + FUTURE_DAYS
    n = F.col("id").cast("int")
    date = F.date_add(F.lit(lo), n)
    day = F.dayofmonth(date)
    peaks = order_peaks(spark, folder)
    kind = lambda name: F.when(F.substring(name, 1, 1) <= "2", "Urgent").when(F.col(name).isNotNull(), "Routine")
    plain = spark.range(0, days, 1, 1).withColumn("_date", date).join(
        peaks.withColumnRenamed("date", "_peak"), F.col("_date") == F.col("_peak"), "left")
    return plain.select(
        date.alias("date"), (F.floor(n / 7) + 1000).cast("int").alias("wm_yr_wk"),
        F.concat(F.lit("d_"), n + 1).alias("d"),
        (day <= 10).cast("int").alias("snap_CA"),
        day.between(6, 15).cast("int").alias("snap_TX"),
        day.between(11, 20).cast("int").alias("snap_WI"),
        F.col("leading").alias("event_name_1"), kind("leading").alias("event_type_1"),
        F.col("second").alias("event_name_2"), kind("second").alias("event_type_2"),
    )


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Items on offer, from the part table: one number in fifty has been taken off."""
    numbers = table(spark, folder, "part").select(item_number("p_partkey").alias("item_no")).distinct()
    return numbers.filter("item_no % 50 <> 7").select(_padded("ITEM_", F.col("item_no"), 6).alias("item_id"))


def order_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days with an order, as keys."""
    return table(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key")).distinct()


def delivered_wide(wide: DataFrame) -> DataFrame:
    """The wide demand with repeated series, negative first days and unknown states, planted by item number."""
    n = F.substring("item_id", 6, 6).cast("int")
    planted = wide.withColumns({
        "d_1": F.when(n % 13 == 4, F.lit(-1).cast("long")).otherwise(F.col("d_1")),
        "state_id": F.when(n % 17 == 5, F.lit("XX")).otherwise(F.col("state_id")),
    })
    return planted.unionByName(planted.filter(n % 11 == 3))


def delivered_prices(prices_rows: DataFrame) -> DataFrame:
    """The prices with missing, negative and repeated ones."""
    key = F.substring("item_id", 6, 6).cast("int") + F.col("wm_yr_wk")
    planted = prices_rows.withColumn(
        "sell_price", F.when(key % 211 == 3, F.lit(None).cast("double")).when(key % 307 == 5, -F.col("sell_price")).otherwise(F.col("sell_price")))
    return planted.unionByName(planted.filter(key % 401 == 7))


def delivered_lines(cleaned: DataFrame) -> DataFrame:
    """Clean lines with conflicts inside orders: another market, or no segment, on about half the lines of some orders."""
    some = F.substring("order_item_id", 1, 1) < "8"
    return cleaned.withColumns({
        "market": F.when((F.col("order_id") % 211 == 9) & some, F.lit("elsewhere")).otherwise(F.col("market")),
        "customer_segment": F.when((F.col("order_id") % 307 == 5) & some, F.lit(None).cast("string")).otherwise(F.col("customer_segment")),
    })


def delivered_sales(sales: DataFrame) -> DataFrame:
    """The panel with the defects a delivery may have, planted by key arithmetic: negative units, missing and negative prices,
    repeated and missing days, date keys that belong to another day."""
    key = F.substring("item_id", 6, 6).cast("int") + F.datediff("date", F.lit(dt.date(1990, 1, 1)))
    hit = lambda n, rest: key % n == rest
    planted = sales.filter(~hit(701, 17)).withColumns({
        "units_sold": F.when(hit(503, 11), F.lit(-1).cast("long")).otherwise(F.col("units_sold")),
        "sell_price": F.when(hit(53, 7), F.lit(None).cast("double")).when(hit(307, 5), -F.col("sell_price")).otherwise(F.col("sell_price")),
        "date_key": F.when(hit(809, 19), F.col("date_key") + 1).otherwise(F.col("date_key")),
    })
    return planted.withColumn("_copy", F.explode(F.when(hit(607, 13), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_copy")


def item_number(part_key: str) -> Column:
    root = F.sqrt(F.col(part_key).cast("double"))
    return F.when(F.col(part_key) % 4 == 0, F.floor(root)).otherwise(F.floor(F.sqrt(root) * 3.0)).cast("int")


def sold(spark: SparkSession, folder: str) -> DataFrame:
    """Units, quantity and cents per item, store and order date.

    A line takes its supplier's store before it meets its order, so the lines are shuffled once by order and once by item, store and
    date. Summing them per supplier first saved nothing: an item, supplier and date seldom has two lines.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", item_number("l_partkey").alias("item_no"), "l_suppkey",
        F.col("l_quantity").cast("long").alias("quantity"),
        hundredths("l_extendedprice").alias("cents"),
    )
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    stores = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(F.col("s_suppkey").alias("l_suppkey"), (F.col("n_regionkey") % 3).alias("store_no"))
    # Written, they have a size by which Spark decides whether to broadcast them; that of a join is guessed far too large.
    stores = materialize(stores, "supplier_stores")
    in_store = lines.join(stores, "l_suppkey").drop("l_suppkey")
    return in_store.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("item_no", "store_no", "date").agg(
        F.count(F.lit(1)).alias("units"), F.sum("quantity").alias("quantity"), F.sum("cents").alias("cents")
    ).select(
        _padded("ITEM_", F.col("item_no"), 6).alias("item_id"), F.concat(F.lit("S_"), "store_no").alias("store_id"),
        "item_no", "store_no", "date", "units", "quantity", "cents",
    )


def durations(spark: SparkSession, folder: str) -> DataFrame:
    """Recorded days between order and shipment per item and store, with the number of lines that took them. Impossible ones are left in. Ship dates of
    the source lie years from the order, so they count modulo eight days, as in `raw_order_lines`."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", item_number("l_partkey").alias("item_no"), "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    stores = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", F.concat(F.lit("S_"), F.col("n_regionkey") % 3).alias("store_id"))
    days = F.pmod(F.datediff("l_shipdate", "o_orderdate"), F.lit(8))
    shipped = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "days", F.when(F.col("o_orderkey") % 97 == 3, F.lit(-1)).otherwise(days))
    # Equal durations of an item and supplier meet the suppliers as one row.
    counted = shipped.groupBy("item_no", "l_suppkey", "days").agg(F.count(F.lit(1)).alias("lines"))
    return counted.join(stores, F.col("l_suppkey") == F.col("s_suppkey")).select(
        _padded("ITEM_", F.col("item_no"), 6).alias("item_id"), "store_id", "days", "lines")


def _series(sold_rows: DataFrame) -> tuple[DataFrame, list[Column]]:
    """The series, and the columns of the panel that belong to one."""
    state = F.element_at(F.array(F.lit("CA"), F.lit("TX"), F.lit("WI")), F.col("store_no") + 1)
    department = F.col("item_no") % 3
    return sold_rows.select("item_id", "store_id", "item_no", "store_no").distinct(), [
        F.concat_ws("_", "item_id", "store_id").alias("id"), F.col("item_id"),
        F.concat(F.lit("D"), department).alias("dept_id"), F.concat(F.lit("C"), department % 2).alias("cat_id"),
        F.col("store_id"), state.alias("state_id"),
    ]


def demand(sold_rows: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """Every series on every day of history, with zero where nothing was sold."""
    series, columns = _series(sold_rows)
    dense = series.select(*columns, F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("date"))
    return dense.join(sold_rows.select("item_id", "store_id", "date", "units"), ["item_id", "store_id", "date"], "left").select(
        "id", "item_id", "dept_id", "cat_id", "store_id", "state_id",
        F.concat(F.lit("d_"), F.datediff("date", F.lit(lo)) + 1).alias("d"),
        F.coalesce("units", F.lit(0).cast("long")).alias("units_sold"),
    )


def priced_demand(sold_rows: DataFrame, price_rows: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """`demand` with the price of the week, in ranges of store, year and item.

    Whole weeks of a series meet their sales and their price, and become days after the last shuffle: days, many and wide, are never
    shuffled. How many ranges there are goes by the days, since a week is short before it becomes days.
    """
    days = (hi - lo).days + 1
    series, columns = _series(sold_rows)
    n = F.datediff("date", F.lit(lo))
    weekly = sold_rows.filter("date IS NOT NULL").groupBy("item_id", "store_id", (F.floor(n / 7) + 1000).cast("int").alias("wm_yr_wk")).agg(
        *[F.max(F.when(n % 7 == k, F.col("units"))).alias(f"_{k}") for k in range(7)])
    weeks = F.explode(F.sequence(F.lit(1000), F.lit(1000 + (days - 1) // 7))).alias("wm_yr_wk")
    key = ["item_id", "store_id", "wm_yr_wk"]
    priced = series.select("item_id", "store_id", "item_no", "store_no", weeks).join(weekly, key, "left").join(
        price_rows.select(*key, "sell_price"), key, "left")
    ranges = -(-series.count() * days // RANGE_DAYS)
    placed = priced.repartitionByRange(
        max(1, ranges), "store_id", F.year(F.date_add(F.lit(lo), (F.col("wm_yr_wk") - 1000) * 7)), "item_id")
    units = F.array(*[F.coalesce(f"_{k}", F.lit(0).cast("long")) for k in range(7)])
    day = (F.col("wm_yr_wk") - 1000) * 7 + F.col("_k") + 1
    daily = placed.select("item_id", "store_id", "item_no", "store_no", "wm_yr_wk", "sell_price", F.posexplode(units).alias("_k", "units_sold"))
    return daily.filter(day <= days).select(*columns, F.concat(F.lit("d_"), day).alias("d"), "units_sold", "sell_price")


def wide_demand(long_demand: DataFrame, days: int) -> DataFrame:
    """The long demand as one row per series and one column per day. The days of a series are
    gathered in date order (a bounded array: the calendar) and spread over the columns; a pivot over
    thousands of values ran much longer."""
    day = F.substring("d", 3, 10).cast("int")
    gathered = long_demand.groupBy("id", "item_id", "dept_id", "cat_id", "store_id", "state_id").agg(
        F.array_sort(F.collect_list(F.struct(day.alias("n"), "units_sold"))).alias("days")
    )
    units = gathered.select(*[c for c in gathered.columns if c != "days"], F.col("days.units_sold").alias("units"))
    return units.selectExpr("*", *[f"units[{n}] AS d_{n + 1}" for n in range(days)]).drop("units")


def prices(sold_rows: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """A listed price for each series and week from its first sale on: the mean price of the week,
    in whole cents, or the last one before a week without sales."""
    from pyspark.sql import Window

    week = (F.floor(F.datediff("date", F.lit(lo)) / 7) + 1000).cast("int")
    last_week = ((hi - lo).days + FUTURE_DAYS) // 7 + 1000
    weekly = sold_rows.groupBy("item_id", "store_id", week.alias("wm_yr_wk")).agg(
        F.sum("quantity").alias("quantity"), F.sum("cents").alias("cents")
    ).withColumn("price_cents", F.expr("(2 * cents + quantity) DIV (2 * quantity)"))
    listed = weekly.groupBy("item_id", "store_id").agg(F.min("wm_yr_wk").alias("first_week")).select(
        "item_id", "store_id", F.explode(F.sequence("first_week", F.lit(last_week))).alias("wm_yr_wk")
    )
    # One row per week in a series.
    so_far = Window.partitionBy("item_id", "store_id").orderBy("wm_yr_wk").rowsBetween(Window.unboundedPreceding, 0)
    return listed.join(weekly, ["item_id", "store_id", "wm_yr_wk"], "left").select(
        "store_id", "item_id", "wm_yr_wk",
        (F.last("price_cents", ignorenulls=True).over(so_far) / 100.0).cast("double").alias("sell_price"),
    )


def unknown_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Part numbers of lines that the part table doesn't have, none as a rule."""
    return table(spark, folder, "lineitem").filter("l_partkey is not null").select("l_partkey").distinct().join(
        table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_anti")


def order_heads(spark: SparkSession, folder: str, unknown: DataFrame | None = None) -> DataFrame:
    """What the lines of an order share, per order with a line; with `unknown` (see `unknown_parts`), per order with a line whose
    part is known.

    The orders meet their customers first and their lines last, so the rows lie by order and what groups them by order needs no
    further shuffle. The lines of an order lie together in the source and are added up before their shuffle.
    """
    market = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "n_name", "r_name")
    customers = table(spark, folder, "customer").join(market, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "n_name", "r_name",
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("segment"),
    )
    lines = table(spark, folder, "lineitem")
    shipped = F.min("l_shipdate").cast("date").alias("first_ship")
    if unknown is None:
        first_ship = lines.groupBy("l_orderkey").agg(shipped)
    else:
        marked = lines.join(unknown.withColumn("_unknown", F.lit(True)), "l_partkey", "left")
        known = F.max(F.col("_unknown").isNull() & F.col("l_partkey").isNotNull()).alias("known")
        first_ship = marked.groupBy("l_orderkey").agg(shipped, known).filter("known").drop("known")
    key, date = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    shipping = F.when(key % 97 == 3, F.lit(-1)).otherwise(F.pmod(F.datediff("first_ship", date), F.lit(8))).cast("int")
    scheduled = (F.substring("o_orderpriority", 1, 1).cast("int") + 1)
    late = (F.col("actual_days") > F.col("scheduled_days")).cast("int")
    return (
        table(spark, folder, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(first_ship, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")
        .withColumns({"actual_days": shipping, "scheduled_days": scheduled, "order_day": date})
        .select(
            "o_orderkey", "c_name", "n_name", "r_name", "segment", "actual_days", "scheduled_days",
            F.when(F.col("o_orderstatus") == "F", F.date_format("order_day", "yyyy-MM-dd"))
            .when(F.col("o_orderstatus") == "O", F.date_format("order_day", "MM/dd/yyyy HH:mm"))
            .otherwise(F.date_format("order_day", "MM/dd/yyyy")).alias("ordered"),
            F.when(key % 50 == 7, F.lit("not recorded")).otherwise(F.date_format(
                F.date_add("order_day", F.col("actual_days") + F.when(key % 10 == 0, 3).otherwise(0)), "yyyy-MM-dd"
            )).alias("shipped"),
            F.when(key % 40 == 0, 1 - late).otherwise(late).alias("late_flag"),
            F.concat(F.lit(" "), F.initcap("o_orderpriority"), F.lit(" ")).alias("mode"),
            F.when(F.col("o_orderstatus") == "F", "COMPLETE").when(F.col("o_orderstatus") == "O", "Processing")
            .otherwise("CANCELED").alias("status"),
        )
    )


def _order_columns() -> dict[str, Column]:
    """The order file's columns that are the same on all lines of an order."""
    return {
        "Order Id": F.col("o_orderkey"),
        "order date (DateOrders)": F.col("ordered"), "shipping date (DateOrders)": F.col("shipped"),
        "Days for shipping (real)": F.col("actual_days"), "Days for shipment (scheduled)": F.col("scheduled_days"),
        "Late_delivery_risk": F.col("late_flag"), "Shipping Mode": F.col("mode"), "Market": F.col("r_name"),
        "Order Region": F.col("n_name"), "Customer Segment": F.col("segment"), "Order Status": F.col("status"),
        "Customer Fname": F.col("c_name"),
    }


def raw_orders(spark: SparkSession, folder: str, unknown: DataFrame) -> DataFrame:
    """The orders of `raw_order_lines` once each, under the same headers, without what belongs to a line."""
    columns = _order_columns() | {"Order Item Id": F.lit(None).cast("string")}
    return order_heads(spark, folder, unknown).select(*[c.alias(name) for name, c in columns.items()])


def uneven_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order keys of lines that `order_heads` doesn't have just once, none as a rule, with one entry in `copies` for each time it has
    them. Keys alone are shuffled, those of the lines once per order."""
    market = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey")
    customers = table(spark, folder, "customer").join(market, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey")
    found = table(spark, folder, "orders").select("o_orderkey", "o_custkey").join(
        customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("o_orderkey").agg(F.count(F.lit(1)).cast("int").alias("times"))
    ordered = table(spark, folder, "lineitem").filter("l_orderkey IS NOT NULL").select("l_orderkey").distinct()
    times = F.coalesce("times", F.lit(0))
    return ordered.join(found, F.col("l_orderkey") == F.col("o_orderkey"), "left").filter(times != 1).select(
        "l_orderkey", F.array_repeat(F.lit(0), times).alias("copies"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts and key of every line."""
    quantity = F.col("l_quantity").cast("long")
    cents = hundredths("l_extendedprice")
    discount = hundredths("l_discount")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", quantity.alias("quantity"), cents.alias("cents"),
        # A line has no key of its own: the text of all its columns makes one.
        F.unhex(F.md5(F.concat_ws(
            "|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", quantity, cents, discount,
            hundredths("l_tax"), "l_returnflag", "l_linestatus",
            F.col("l_shipdate").cast("date").cast("string"),
        ))).alias("line_id"),
        F.floor((cents * (100 - discount) + 50) / 100).alias("net_cents"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)).alias("returned"),
    )


def _valued(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    """`_lines` with what they get from their parts."""
    parts = table(spark, folder, "part").select(
        "p_partkey", "p_name", "p_type", hundredths("p_retailprice").alias("retail_cents")
    )
    sign = F.when(F.col("returned"), -1).otherwise(1)
    profit = F.when(
        F.col("l_partkey") % 101 != 5, (2 * F.col("net_cents") - F.col("quantity") * F.col("retail_cents")) / 200.0
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "line_id", "p_type", "p_name", "quantity", "cents",
        (sign * F.col("net_cents") / 100.0).cast("double").alias("total"), profit.cast("double").alias("profit"),
    )


def _line_columns() -> dict[str, Column]:
    """The order file's columns that belong to a line."""
    return {
        "Order Item Id": F.lower(F.hex("line_id")), "Category Name": F.col("p_type"), "Product Name": F.col("p_name"),
        "Order Item Quantity": F.col("quantity"), "Order Item Total": F.col("total"),
        "Sales": (F.col("cents") / 100.0).cast("double"), "Benefit per order": F.col("profit"),
    }


def raw_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines under the headers of the raw order file, personal columns included, with the
    kinds of defect such a file has: mixed date formats, unreadable dates, negative amounts,
    impossible durations, missing profit.

    A line meets its part first and carries on with amounts and a key of 16 bytes; the order's columns come last, so they are
    never shuffled once per line, and the rows lie by order.
    """
    valued = _valued(spark, folder, _lines(spark, folder))
    joined = valued.join(order_heads(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"))
    columns = _order_columns() | _line_columns()
    names = (
        "Order Id", "Order Item Id", "order date (DateOrders)", "shipping date (DateOrders)", "Days for shipping (real)",
        "Days for shipment (scheduled)", "Late_delivery_risk", "Shipping Mode", "Market", "Order Region", "Category Name",
        "Customer Segment", "Product Name", "Order Status", "Order Item Quantity", "Order Item Total", "Sales",
        "Benefit per order", "Customer Fname")
    return joined.select(*[columns[name].alias(name) for name in names])


def raw_line_values(spark: SparkSession, folder: str, uneven: DataFrame) -> DataFrame:
    """The rows of `raw_order_lines` under the same headers, without what belongs to the order but its id and an empty date.

    As good as every line has one order, so lines needn't be shuffled to find out: they only meet the few orders that are an
    exception (see `uneven_orders`), which drop or repeat them as the join with the orders does.
    """
    lines = _lines(spark, folder).filter("l_orderkey IS NOT NULL").join(uneven, "l_orderkey", "left")
    kept = lines.select(*[c for c in lines.columns if c != "copies"], F.explode(F.coalesce("copies", F.array(F.lit(0))))).drop("col")
    columns = {"Order Id": F.col("l_orderkey"), "order date (DateOrders)": F.lit(None).cast("string")} | _line_columns()
    return _valued(spark, folder, kept).select(*[c.alias(name) for name, c in columns.items()])
