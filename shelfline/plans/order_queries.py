"""Queries over order lines and deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import dimensions, orders, quality
from shelfline.plans import marts, reports
from shelfline.plans.data import Data
from shelfline.plans.query import Query
from shelfline.sources.readers import admit_order_columns

_ELIGIBLE = "count(*) FILTER (delivery_eligible)"
_LATE = f"""count(*) AS total_orders, {_ELIGIBLE} AS eligible_orders, CAST(coalesce(sum(late_order), 0) AS BIGINT) AS late_orders,
 avg(late_order) AS late_delivery_rate, avg(positive_delay_days) AS average_delay_days, avg(delay_days) AS average_signed_delay,
 avg(actual_shipping_days) FILTER (delivery_eligible) AS actual_shipping_days,
 avg(scheduled_shipping_days) FILTER (delivery_eligible) AS scheduled_shipping_days"""
_SUMS = "sum(sales) AS sales, sum(profit) AS profit"


def _stacked(table: str, dimensions, columns: str, where: str = "true") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, {c} AS segment, {columns} FROM {table} WHERE {where}" for c in dimensions
    )


def _cohort(**wanted):
    return lambda d: orders.consistent(orders.filter_cohort(d.cohort, **wanted))


_CONFLICT = "(count(DISTINCT {c}) > 1 OR (count({c}) > 0 AND count({c}) < count(*)))"

QUERIES = [
    # --- analytical queries ---
    Query("i19_late_rate_by_mode", lambda d: reports.late_rate_by_mode(d.delivery),
          "SELECT shipping_mode, count(*) AS eligible_orders, avg(late_order) AS late_rate FROM delivery WHERE delivery_eligible GROUP BY 1",
          "late_rate"),
    Query("i20_delay_by_region", lambda d: reports.delay_by_region(d.delivery),
          """SELECT region, avg(positive_delay_days) AS average_delay, quantile_cont(positive_delay_days, 0.9) AS p90_delay
             FROM delivery WHERE delivery_eligible GROUP BY 1""", "average_delay p90_delay"),
    Query("i21_margin_by_category", lambda d: reports.margin_by_category(d.lines),
          "SELECT category, sum(profit) / nullif(sum(sales), 0) AS margin FROM lines WHERE NOT invalid_sales_flag GROUP BY 1", "margin"),
    Query("i22_loss_making_orders", lambda d: reports.loss_making_orders(d.lines),
          f"SELECT order_id, {_SUMS} FROM lines WHERE NOT invalid_sales_flag GROUP BY 1 HAVING sum(profit) < 0", "sales profit"),
    # Margins of these tables lie near .8, so a margin is low here below .83.
    Query("i23_big_sellers_with_low_margin", lambda d: reports.big_sellers_with_low_margin(d.lines, margin=0.83),
          f"""SELECT *, profit / nullif(sales, 0) AS margin FROM (SELECT product_name, {_SUMS} FROM lines WHERE NOT invalid_sales_flag GROUP BY 1)
              WHERE profit / nullif(sales, 0) < 0.83 AND sales >= (SELECT quantile_cont(sales, 0.75) FROM (
                SELECT sum(sales) AS sales FROM lines WHERE NOT invalid_sales_flag GROUP BY product_name))""", "sales profit margin"),
    Query("i24_late_order_pareto", lambda d: reports.late_order_pareto(d.delivery),
          """SELECT region, late_orders, CAST(sum(late_orders) OVER (ORDER BY late_orders DESC, region) AS DOUBLE)
                    / nullif(sum(late_orders) OVER (), 0) AS cumulative_share
             FROM (SELECT region, CAST(sum(late_order) AS BIGINT) AS late_orders FROM delivery WHERE delivery_eligible GROUP BY 1)""",
          "cumulative_share"),
    # --- line and order facts ---
    Query("o01_line_facts", lambda d: d.lines, "SELECT * FROM lines", "quantity sales profit profit_margin"),
    Query("o01_delivery_facts", lambda d: d.delivery, "SELECT * FROM delivery",
          "actual_shipping_days scheduled_shipping_days delay_days positive_delay_days"),
    Query("o02_delivery_summary", lambda d: orders.delivery_summary(d.delivery),
          f"SELECT dimension, segment, {_LATE} FROM ({_stacked('delivery', orders.DELIVERY_DIMENSIONS, '*')}) GROUP BY 1, 2",
          "late_delivery_rate average_delay_days average_signed_delay actual_shipping_days scheduled_shipping_days"),
    Query("o03_category_delivery", lambda d: orders.category_delivery(d.lines, d.delivery),
          f"""SELECT category, count(*) AS orders, {_ELIGIBLE} AS eligible_orders, CAST(coalesce(sum(late_order), 0) AS BIGINT) AS late_orders,
                     sum(late_order)::DOUBLE / nullif({_ELIGIBLE}, 0) AS late_delivery_rate
              FROM (SELECT DISTINCT order_id, category FROM lines) JOIN delivery USING (order_id) GROUP BY 1""", "late_delivery_rate"),
    Query("o04_profit_summary", lambda d: orders.profit_summary(d.lines),
          f"""SELECT dimension, segment, {_SUMS}, count(DISTINCT order_id) AS order_count, sum(profit) / nullif(sum(sales), 0) AS profit_margin
              FROM ({_stacked('lines', orders.PROFIT_DIMENSIONS, 'order_id, sales, profit', 'NOT invalid_sales_flag')}) GROUP BY 1, 2""",
          "sales profit profit_margin"),
    Query("o05_order_profit", lambda d: orders.order_profit(d.lines),
          f"SELECT order_id, {_SUMS}, coalesce(sum(profit) < 0, false) AS loss_making_order FROM lines WHERE NOT invalid_sales_flag GROUP BY 1",
          "sales profit"),
    Query("o06_cohort_metrics", lambda d: orders.cohort_metrics(_cohort(market="EUROPE", segment="all", month="all")(d)),
          """SELECT count(DISTINCT order_id) AS orders, count(*) AS selected_lines, sum(sales) AS revenue, sum(coalesce(profit, 0)) AS profit,
                    count(DISTINCT order_id) FILTER (actual_shipping_days > scheduled_shipping_days) AS late_orders,
                    count(DISTINCT order_id) FILTER (actual_shipping_days > scheduled_shipping_days)::DOUBLE / count(DISTINCT order_id) AS late_order_share
             FROM lines JOIN order_heads ON o_orderkey = order_id WHERE lines.market = 'europe'""",
          "revenue profit late_order_share"),
    Query("o06_cohort_categories", lambda d: orders.cohort_categories(_cohort(market="all", segment="BUILDING", month="all")(d)),
          """SELECT upper(category) AS category, sum(sales) AS revenue, sum(coalesce(profit, 0)) AS profit, sum(quantity) AS units, count(*) AS lines,
                    100 * sum(coalesce(profit, 0)) / nullif(sum(sales), 0) AS margin_pct FROM lines WHERE customer_segment = 'building' GROUP BY 1""",
          "revenue profit units margin_pct"),
    Query("o06_cohort_trend", lambda d: orders.cohort_trend(_cohort()(d)),
          "SELECT strftime(order_date, '%Y-%m') AS month, sum(sales) AS revenue FROM lines GROUP BY 1", "revenue"),
    # --- aggregates, joins, quality ---
    Query("a05_monthly_orders", lambda d: orders.monthly_orders(d.lines),
          f"SELECT CAST(date_trunc('month', order_date) AS DATE) AS period, {_SUMS}, count(DISTINCT order_id) AS orders FROM lines GROUP BY 1",
          "sales profit"),
    Query("p07_normal_labels", lambda d: d.cleaned.groupBy("customer_segment", "order_status").agg(F.count(F.lit(1)).alias("rows")),
          """SELECT customer_segment, CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'processing' ELSE 'canceled' END AS order_status,
                    count(*) AS rows FROM lines JOIN orders ON o_orderkey = order_id GROUP BY 1, 2"""),
    Query("p08_parsed_dates", lambda d: d.cleaned.select("order_item_id", "order_date", "shipping_date"),
          """SELECT order_item_id, order_date, CASE WHEN order_id % 50 <> 7 THEN CAST(order_date + CAST(CASE WHEN order_id % 97 = 3 THEN -1 ELSE actual_shipping_days END
                    + CASE WHEN order_id % 10 = 0 THEN 3 ELSE 0 END AS INTEGER) AS DATE) END AS shipping_date
             FROM lines JOIN (SELECT o_orderkey, actual_shipping_days FROM order_heads) ON o_orderkey = order_id"""),
    Query("p10_line_flags", lambda d: d.cleaned.select("order_item_id", "invalid_sales_flag", "abnormal_profit_flag", "loss_making_line", "profit_margin"),
          "SELECT order_item_id, invalid_sales_flag, abnormal_profit_flag, loss_making_line, profit_margin FROM lines", "profit_margin"),
    Query("p13_duration_mismatch", lambda d: d.cleaned.groupBy("date_duration_mismatch").agg(F.count(F.lit(1)).alias("rows")),
          """SELECT (order_id % 50 <> 7 AND order_id % 10 = 0) AS date_duration_mismatch, count(*) AS rows FROM lines GROUP BY 1"""),
    Query("q08_order_conflicts", lambda d: orders.order_conflicts(d.delivered_lines),
          "SELECT * FROM (SELECT order_id, " + ", ".join(f"{_CONFLICT.format(c=c)} AS {c}" for c in orders.ORDER_ATTRIBUTES)
          + " FROM delivered_lines GROUP BY 1) WHERE " + " OR ".join(orders.ORDER_ATTRIBUTES)),
    Query("q10_quality_counts", lambda d: orders.quality_counts(d.cleaned),
          """SELECT issue, rows FROM (
               SELECT count(*) AS source_rows, count(*) - count(DISTINCT order_id) AS repeated_order_ids, 0::BIGINT AS invalid_order_date,
                      count(*) FILTER (order_id % 50 = 7) AS invalid_shipping_date,
                      count(*) FILTER (delivery_eligible AND order_id % 40 = 0) AS late_flag_disagreement,
                      count(*) FILTER (invalid_sales_flag) AS invalid_sales_rows, count(*) FILTER (abnormal_profit_flag) AS abnormal_profit_rows,
                      count(*) FILTER (NOT delivery_eligible) AS ineligible_delivery_rows,
                      count(*) FILTER (order_id % 50 <> 7 AND order_id % 10 = 0) AS date_duration_mismatch
               FROM lines JOIN (SELECT order_id, delivery_eligible FROM delivery) USING (order_id))
             UNPIVOT (rows FOR issue IN (source_rows, repeated_order_ids, invalid_order_date, invalid_shipping_date, late_flag_disagreement,
               invalid_sales_rows, abnormal_profit_rows, ineligible_delivery_rows, date_duration_mismatch))"""),
    Query("s03_admitted_columns", lambda d: admit_order_columns(d.raw_lines)[0].select("order_item_id", "shipping_mode", "order_item_total"),
          """SELECT order_item_id, p.o_orderpriority_label AS shipping_mode, sales AS order_item_total FROM lines
             JOIN (SELECT o_orderkey, upper(substr(o_orderpriority, 1, 1)) || substr(o_orderpriority, 2, 1) || replace(lower(substr(o_orderpriority, 3)), 'specified', 'Specified') AS o_orderpriority_label FROM orders) AS p ON p.o_orderkey = order_id""",
          "order_item_total"),
    Query("d03_order_dimensions",
          lambda d: orders.in_segments(d.lines.select("category", "market", "region", "shipping_mode", "customer_segment").distinct(),
                                       ("category", "market", "region", "shipping_mode", "customer_segment")).select("dimension", "segment").distinct(),
          f"SELECT DISTINCT dimension, segment FROM ({_stacked('lines', ('category', 'market', 'region', 'shipping_mode', 'customer_segment'), '1 AS one')})"),
    Query("d11_mart_shipping_mode", lambda d: marts.shipping_mode_performance(d.delivery),
          f"""SELECT shipping_mode, {_ELIGIBLE} AS eligible_orders, CAST(sum(late_order) AS BIGINT) AS late_orders,
                     avg(late_order) AS late_delivery_rate, avg(positive_delay_days) AS average_delay_days FROM delivery GROUP BY 1""",
          "late_delivery_rate average_delay_days"),
    Query("d12_mart_profitability", lambda d: marts.profitability(d.lines),
          f"""SELECT category, market, region, {_SUMS}, sum(profit) / nullif(sum(sales), 0) AS profit_margin FROM lines
              WHERE NOT invalid_sales_flag GROUP BY 1, 2, 3""", "sales profit profit_margin"),
    Query("d14_mart_delivery", lambda d: d.delivery.select("order_id", "delivery_eligible", "late_order"),
          "SELECT order_id, delivery_eligible, late_order FROM delivery"),
]
