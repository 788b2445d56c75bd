"""Independent SQL definitions of the derived tables, for checking the Spark plans.

Each entry is the body of a common table expression over the driver tables. `with_tables` puts the
ones a statement mentions, and those they mention, in front of it.
"""

from __future__ import annotations

import re

TABLES: dict[str, str] = {}


def with_tables(statement: str) -> str:
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for word in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if word in TABLES and word not in seen:
                seen.add(word)
                visit(TABLES[word])
                needed.append(word)

    visit(statement)
    if not needed:
        return statement
    recursive = "RECURSIVE " if any("UNION ALL -- step" in TABLES[n] for n in needed) else ""
    bodies = ",\n".join(
        f"{n} AS {'' if 'UNION ALL -- step' in TABLES[n] else 'MATERIALIZED '}({TABLES[n]})" for n in needed
    )
    return f"WITH {recursive}{bodies}\n{statement}"


# --- panel --------------------------------------------------------------------------------------

TABLES["bounds"] = """
SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders"""

TABLES["calendar"] = """
SELECT CAST(lo + n AS DATE) AS date, CAST(n // 7 + 1000 AS INTEGER) AS wm_yr_wk, 'd_' || (n + 1) AS d,
       CAST(day(lo + n) <= 10 AS INTEGER) AS snap_CA,
       CAST(day(lo + n) BETWEEN 6 AND 15 AS INTEGER) AS snap_TX,
       CAST(day(lo + n) BETWEEN 11 AND 20 AS INTEGER) AS snap_WI,
       names[1] AS event_name_1, CASE WHEN names[1][1] <= '2' THEN 'Urgent' WHEN names[1] IS NOT NULL THEN 'Routine' END AS event_type_1,
       names[2] AS event_name_2, CASE WHEN names[2][1] <= '2' THEN 'Urgent' WHEN names[2] IS NOT NULL THEN 'Routine' END AS event_type_2
FROM (SELECT lo, CAST(unnest(range(0, date_diff('day', lo, hi) + 29)) AS INTEGER) AS n FROM bounds)
     LEFT JOIN peaks ON peaks.day = lo + n"""

TABLES["peaks"] = """
SELECT day, names FROM (SELECT day, sum(n) AS n, list(o_orderpriority ORDER BY n DESC, o_orderpriority) AS names
      FROM (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) GROUP BY 1)
QUALIFY n > avg(n) OVER () + 1.5::DOUBLE * stddev_samp(n) OVER ()"""

TABLES["catalogue"] = """
SELECT DISTINCT 'ITEM_' || lpad(CAST(item_no AS VARCHAR), 6, '0') AS item_id
FROM (SELECT CAST(CASE WHEN p_partkey % 4 = 0 THEN floor(sqrt(p_partkey)) ELSE floor(sqrt(sqrt(p_partkey)) * 3.0) END AS INTEGER) AS item_no
      FROM part) WHERE item_no % 50 <> 7"""

TABLES["delivered_demand"] = """
SELECT id, item_id, store_id, CASE WHEN n % 17 = 5 THEN 'XX' ELSE state_id END AS state_id, d,
       CASE WHEN n % 13 = 4 AND d = 'd_1' THEN -1 ELSE units_sold END AS units_sold
FROM (SELECT *, CAST(substr(item_id, 6, 6) AS INTEGER) AS n FROM demand) JOIN (SELECT unnest([0, 1]) AS c) ON c = 0 OR n % 11 = 3"""

TABLES["delivered_prices"] = """
SELECT store_id, item_id, wm_yr_wk, CASE WHEN k % 211 = 3 THEN NULL WHEN k % 307 = 5 THEN -sell_price ELSE sell_price END AS sell_price
FROM (SELECT *, CAST(substr(item_id, 6, 6) AS INTEGER) + wm_yr_wk AS k FROM prices) JOIN (SELECT unnest([0, 1]) AS c) ON c = 0 OR k % 401 = 7"""

TABLES["delivered"] = """
SELECT * EXCLUDE (k, c, units_sold, sell_price, date_key), CASE WHEN k % 503 = 11 THEN -1 ELSE units_sold END AS units_sold,
       CASE WHEN k % 53 = 7 THEN NULL WHEN k % 307 = 5 THEN -sell_price ELSE sell_price END AS sell_price,
       CASE WHEN k % 809 = 19 THEN date_key + 1 ELSE date_key END AS date_key
FROM (SELECT *, CAST(substr(item_id, 6, 6) AS INTEGER) + date_diff('day', DATE '1990-01-01', date) AS k FROM sales)
     JOIN (SELECT unnest([0, 1]) AS c) ON c = 0 OR k % 607 = 13
WHERE k % 701 <> 17"""

TABLES["sold"] = """
SELECT item_no, store_no, 'ITEM_' || lpad(CAST(item_no AS VARCHAR), 6, '0') AS item_id, 'S_' || store_no AS store_id,
       date, CAST(count(*) AS BIGINT) AS units, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(cents) AS BIGINT) AS cents
FROM (SELECT CAST(CASE WHEN l_partkey % 4 = 0 THEN floor(sqrt(l_partkey)) ELSE floor(sqrt(sqrt(l_partkey)) * 3.0) END AS INTEGER) AS item_no,
             n_regionkey % 3 AS store_no, CAST(o_orderdate AS DATE) AS date,
             CAST(l_quantity AS BIGINT) AS quantity, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey
           JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
GROUP BY ALL"""

TABLES["durations"] = """
SELECT * FROM (
  SELECT 'ITEM_' || lpad(CAST(CAST(CASE WHEN l_partkey % 4 = 0 THEN floor(sqrt(l_partkey)) ELSE floor(sqrt(sqrt(l_partkey)) * 3.0) END AS INTEGER) AS VARCHAR), 6, '0') AS item_id,
         'S_' || (n_regionkey % 3) AS store_id, o_orderkey % 97 = 3 AS impossible,
         (date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) % 8 + 8) % 8 AS days
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
WHERE NOT impossible"""

# Each duration's distance from its series' mean and from the mean of all, instead of sums of squares.
TABLES["recorded_lead_times"] = """
WITH own AS (SELECT item_id, store_id, days, avg(days) OVER series AS m, count(*) OVER series AS n, avg(days) OVER () AS g
             FROM durations WINDOW series AS (PARTITION BY item_id, store_id)),
     each_series AS (SELECT item_id, store_id, any_value(m) AS m, any_value(n) AS n, any_value(g) AS g, sum((days - m) ** 2) AS within_ss
             FROM own GROUP BY ALL),
     parts AS (SELECT count(*) AS k, sum(n) AS total, sum(n ** 2) AS squares, sum(within_ss) / nullif(sum(n) - count(*), 0) AS s2, sum(n * (m - g) ** 2) AS ssb
             FROM each_series),
     variances AS (SELECT coalesce(s2, 0) AS s2, greatest(0, coalesce((ssb - (k - 1) * coalesce(s2, 0)) / nullif(total - squares / total, 0), 0)) AS t2 FROM parts)
SELECT item_id, store_id, CAST(n AS BIGINT) AS recorded_durations,
       CASE WHEN s2 > 0 THEN (n * t2 * m + s2 * g) / (n * t2 + s2) ELSE m END AS average_lead_time_days,
       sqrt((within_ss + 5 * s2) / (n - 1 + 5)) AS lead_time_standard_deviation
FROM each_series JOIN variances ON true"""

TABLES["demand"] = """
SELECT s.item_id || '_' || s.store_id AS id, s.item_id, 'D' || (s.item_no % 3) AS dept_id,
       'C' || (s.item_no % 3 % 2) AS cat_id, s.store_id, ['CA', 'TX', 'WI'][s.store_no + 1] AS state_id,
       c.d, c.date, coalesce(f.units, 0) AS units_sold
FROM (SELECT DISTINCT item_id, store_id, item_no, store_no FROM sold) AS s
     JOIN calendar AS c ON c.date <= (SELECT hi FROM bounds)
     LEFT JOIN sold AS f ON f.item_id = s.item_id AND f.store_id = s.store_id AND f.date = c.date"""

TABLES["prices"] = """
SELECT store_id, item_id, wm_yr_wk,
       last_value(price_cents IGNORE NULLS) OVER (PARTITION BY item_id, store_id ORDER BY wm_yr_wk
         ROWS UNBOUNDED PRECEDING) / 100.0::DOUBLE AS sell_price
FROM (SELECT s.item_id, s.store_id, w.wm_yr_wk, p.price_cents
      FROM (SELECT item_id, store_id, min(date) AS first_sale FROM sold GROUP BY ALL) AS s
           JOIN (SELECT wm_yr_wk, max(date) AS week_end FROM calendar GROUP BY ALL) AS w ON w.week_end >= s.first_sale
           LEFT JOIN (SELECT item_id, store_id, wm_yr_wk,
                             (2 * CAST(sum(cents) AS BIGINT) + CAST(sum(quantity) AS BIGINT)) // (2 * CAST(sum(quantity) AS BIGINT)) AS price_cents
                      FROM sold JOIN calendar USING (date) GROUP BY ALL) AS p
             ON p.item_id = s.item_id AND p.store_id = s.store_id AND p.wm_yr_wk = w.wm_yr_wk)"""

TABLES["sales"] = """
SELECT m.id AS series_id, m.item_id, m.dept_id AS department_id, m.cat_id AS category_id, m.store_id, m.state_id,
       m.d, c.date, CAST(strftime(c.date, '%Y%m%d') AS INTEGER) AS date_key, m.units_sold, p.sell_price,
       CASE WHEN m.units_sold = 0 THEN 0.0::DOUBLE ELSE m.units_sold * p.sell_price END AS revenue, c.wm_yr_wk,
       CAST(dayofweek(c.date) AS INTEGER) AS weekday, CAST(month(c.date) AS INTEGER) AS month,
       CAST(quarter(c.date) AS INTEGER) AS quarter, CAST(year(c.date) AS INTEGER) AS year,
       c.event_name_1 AS event_name, c.event_type_1 AS event_type, c.event_name_2, c.event_type_2,
       CASE WHEN m.state_id = 'CA' THEN c.snap_CA WHEN m.state_id = 'TX' THEN c.snap_TX
            WHEN m.state_id = 'WI' THEN c.snap_WI END AS snap_flag,
       CAST(coalesce(c.event_name_1, c.event_name_2) IS NOT NULL AS INTEGER) AS event_flag,
       CAST(dayofweek(c.date) IN (0, 6) AS INTEGER) AS weekend_flag,
       CAST(day(c.date) = 1 AS INTEGER) AS month_start_flag,
       CAST(day(c.date + 1) = 1 AS INTEGER) AS month_end_flag,
       CAST(m.units_sold = 0 AS INTEGER) AS zero_sales_flag
FROM demand AS m LEFT JOIN calendar AS c ON c.d = m.d
     LEFT JOIN prices AS p ON p.item_id = m.item_id AND p.store_id = m.store_id AND p.wm_yr_wk = c.wm_yr_wk"""

TABLES["item_totals"] = "SELECT item_id, sum(revenue) AS revenue FROM sales GROUP BY 1"
TABLES["series_totals"] = """
SELECT item_id, store_id, sum(revenue) AS revenue, stddev_samp(units_sold) / nullif(avg(units_sold), 0) AS cv,
       avg(zero_sales_flag) AS zero_share FROM sales GROUP BY 1, 2"""


def ahead(totals: str, keys: str) -> str:
    """Rows of `totals` with `share`: what ranks before a row, as the running sum through the row less the row itself."""
    return f"""
SELECT *, (through - revenue) / nullif(whole, 0) AS share
FROM (SELECT *, sum(revenue) OVER (ORDER BY place) AS through, sum(revenue) OVER () AS whole
      FROM (SELECT *, row_number() OVER (ORDER BY revenue DESC, {keys}) AS place FROM {totals}))"""


ABC_CLASS = "coalesce((SELECT max(label) FROM (VALUES (-1.0, 'A'), (0.8, 'B'), (0.95, 'C')) AS cut(low, label) WHERE share >= low), 'C')"
XYZ_CLASS = "CASE WHEN zero_share < 0.5 AND cv <= 1.0 THEN CASE WHEN cv <= 0.5 THEN 'X' ELSE 'Y' END ELSE 'Z' END"

TABLES["dim_product"] = "SELECT DISTINCT item_id, department_id, category_id FROM sales"
TABLES["dim_store"] = "SELECT DISTINCT store_id, state_id FROM sales"

_PAST = "OVER (PARTITION BY item_id, store_id ORDER BY date ROWS BETWEEN {} PRECEDING AND 1 PRECEDING)"
TABLES["features"] = (
    "SELECT *, CAST(weekofyear(date) AS INTEGER) AS week, "
    + ", ".join(f"lag(units_sold, {k}) OVER series AS lag_{k}" for k in (1, 7, 14, 28, 56))
    + ", " + ", ".join(f"avg(units_sold) {_PAST.format(k)} AS rolling_mean_{k}" for k in (7, 28, 56))
    + ", " + ", ".join(
        f"stddev_samp(units_sold) {_PAST.format(k)} AS rolling_std_{k}, "
        f"CAST(sum(units_sold) {_PAST.format(k)} AS BIGINT) AS rolling_{k}_day_units, "
        f"sum(revenue) {_PAST.format(k)} AS rolling_{k}_day_revenue" for k in (7, 28))
    + ", sell_price / nullif(lag(sell_price) OVER series, 0) - 1 AS price_change_percentage"
    + ", CAST(date_diff('day', max(date) FILTER (WHERE units_sold > 0) " + _PAST.format("UNBOUNDED")
    + ", date) AS INTEGER) AS days_since_last_sale FROM sales WINDOW series AS (PARTITION BY item_id, store_id ORDER BY date)"
)


def history(origin: str) -> str:
    """Demand statistics of the 90 days up to `origin`."""
    return f"""
SELECT item_id, store_id, category_id, department_id, state_id, avg(units_sold) AS average_daily_demand,
       stddev_samp(units_sold) AS demand_std, sum(revenue) AS revenue, CAST(sum(units_sold) AS BIGINT) AS units_sold,
       avg(zero_sales_flag) AS zero_demand_share, arg_max(sell_price, date) AS last_price
FROM sales WHERE date <= {origin} AND date > {origin} - 90 GROUP BY ALL"""


def segmented(table: str) -> str:
    return f"""
SELECT *, abc || '-' || xyz AS abc_xyz FROM (
  SELECT * EXCLUDE (earlier, everything, pct),
         CASE WHEN everything <= 0 THEN 'C' WHEN earlier / nullif(everything, 0) < 0.8 THEN 'A'
              WHEN earlier / nullif(everything, 0) < 0.95 THEN 'B' ELSE 'C' END AS abc,
         CASE WHEN zero_demand_share >= 0.5 THEN 'Z' WHEN coefficient_of_variation <= 0.5 THEN 'X'
              WHEN coefficient_of_variation <= 1.0 THEN 'Y' ELSE 'Z' END AS xyz,
         CASE WHEN pct <= 1.0::DOUBLE / 3.0::DOUBLE THEN 'low' WHEN pct <= 2 * (1.0::DOUBLE / 3.0::DOUBLE) THEN 'medium' ELSE 'high' END AS volume_segment,
         (earlier + revenue) / nullif(everything, 0) AS cumulative_revenue_share
  FROM (SELECT *, demand_std / nullif(average_daily_demand, 0) AS coefficient_of_variation,
               coalesce(sum(revenue) OVER (ORDER BY revenue DESC, item_id, store_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
               sum(revenue) OVER () AS everything,
               (rank() OVER (ORDER BY average_daily_demand) + (count(*) OVER (PARTITION BY average_daily_demand) - 1) / 2.0::DOUBLE)
                 / count(*) OVER () AS pct
        FROM {table}))"""


TABLES["cohort_revenue"] = """
SELECT item_id, store_id, sum(revenue) AS revenue FROM sales
WHERE date <= (SELECT hi FROM bounds) - 84 AND date > (SELECT hi FROM bounds) - 84 - 90 GROUP BY ALL"""
TABLES["cohort"] = """
SELECT item_id, store_id FROM cohort_revenue
WHERE store_id IN (SELECT store_id FROM cohort_revenue GROUP BY 1 ORDER BY sum(revenue) DESC, store_id LIMIT 2)
ORDER BY revenue DESC, item_id, store_id LIMIT 24"""

TABLES["history_now"] = history("(SELECT hi FROM bounds)")
TABLES["segments_now"] = segmented("history_now")

# --- orders -------------------------------------------------------------------------------------

TABLES["order_heads"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       lower(o_orderpriority) AS shipping_mode, lower(r_name) AS market, lower(n_name) AS region,
       CASE WHEN o_custkey % 11 = 0 THEN 'unknown' ELSE lower(c_mktsegment) END AS customer_segment,
       CAST(CASE WHEN o_orderkey % 97 = 3 THEN -1
            ELSE ((date_diff('day', CAST(o_orderdate AS DATE), first_ship) % 8) + 8) % 8 END AS DOUBLE) AS actual_shipping_days,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 1.0::DOUBLE AS scheduled_shipping_days,
       o_orderstatus = 'P' AS cancelled
FROM orders JOIN (SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS first_ship FROM lineitem GROUP BY ALL) ON l_orderkey = o_orderkey
     JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""

TABLES["delivery"] = """
SELECT o_orderkey AS order_id, order_date, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, shipping_mode,
       market, region, customer_segment, actual_shipping_days, scheduled_shipping_days,
       (actual_shipping_days >= 0 AND NOT cancelled) AS delivery_eligible,
       CASE WHEN actual_shipping_days >= 0 AND NOT cancelled THEN CAST(actual_shipping_days > scheduled_shipping_days AS INTEGER) END AS late_order,
       CASE WHEN actual_shipping_days >= 0 AND NOT cancelled THEN actual_shipping_days - scheduled_shipping_days END AS delay_days,
       CASE WHEN actual_shipping_days >= 0 AND NOT cancelled THEN greatest(actual_shipping_days - scheduled_shipping_days, 0) END AS positive_delay_days
FROM order_heads"""

TABLES["lines"] = """
SELECT *, sales < 0 AS invalid_sales_flag, coalesce(abs(profit) > 2 * abs(sales), false) AS abnormal_profit_flag,
       profit / nullif(sales, 0) AS profit_margin, coalesce(profit < 0, false) AS loss_making_line
FROM (SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT), cents, disc,
                           CAST(round(l_tax * 100) AS BIGINT), l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d'))) AS order_item_id,
             l_orderkey AS order_id, order_date, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, shipping_mode, market, region,
             lower(p_type) AS category, customer_segment, lower(p_name) AS product_name, CAST(l_quantity AS DOUBLE) AS quantity,
             CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -net ELSE net END / 100.0::DOUBLE AS sales,
             CASE WHEN l_partkey % 101 <> 5 THEN (2 * net - CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT)) / 200.0::DOUBLE END AS profit
      FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(round(l_discount * 100) AS BIGINT) AS disc,
                   (CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) + 50) // 100 AS net FROM lineitem)
           JOIN order_heads ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"""

TABLES["delivered_lines"] = """
SELECT * REPLACE (CASE WHEN order_id % 211 = 9 AND substr(order_item_id, 1, 1) < '8' THEN 'elsewhere' ELSE market END AS market,
                  CASE WHEN order_id % 307 = 5 AND substr(order_item_id, 1, 1) < '8' THEN NULL ELSE customer_segment END AS customer_segment)
FROM lines JOIN (SELECT order_id AS delivered_order, actual_shipping_days, scheduled_shipping_days, delivery_eligible, late_order, delay_days,
                        positive_delay_days FROM delivery) ON delivered_order = order_id"""

# --- forecasts ----------------------------------------------------------------------------------

TABLES["folds"] = """
SELECT CAST(f AS INTEGER) AS fold, CAST(hi - (4 - f) * 28 AS DATE) AS origin, ['calibration', 'selection', 'test'][f] AS split_role
FROM (SELECT hi, unnest(range(1, 4))::INTEGER AS f FROM bounds)"""

TABLES["steps"] = """
SELECT item_id, store_id, date, (units_sold - lag(units_sold) OVER (PARTITION BY item_id, store_id ORDER BY date)) ** 2 AS squared_step,
       min(date) FILTER (units_sold <> 0) OVER (PARTITION BY item_id, store_id) AS first_sale FROM sales"""

TABLES["origins"] = """
SELECT fold, origin, split_role, h FROM (SELECT fold, origin, split_role FROM folds UNION ALL SELECT 0, hi, 'production' FROM bounds),
     (SELECT CAST(unnest(range(1, 29)) AS INTEGER) AS h)"""

TABLES["forecasts"] = """
SELECT s.item_id, s.store_id, s.state_id, s.category_id, s.department_id, o.fold, o.split_role, o.origin, CAST(o.origin + o.h AS DATE) AS date,
       CAST(strftime(o.origin + o.h, '%Y%m%d') AS INTEGER) AS date_key, o.h AS horizon, o.model, CAST(s.units_sold AS DOUBLE) AS forecast_units
FROM sales AS s JOIN (
       SELECT *, 'naive' AS model, origin AS source FROM origins UNION ALL
       SELECT *, 'seasonal_7', CAST(origin - 6 + (h - 1) % 7 AS DATE) FROM origins UNION ALL
       SELECT *, 'seasonal_28', CAST(origin - 27 + (h - 1) % 28 AS DATE) FROM origins) AS o ON o.source = s.date
UNION ALL
SELECT s.item_id, s.store_id, s.state_id, s.category_id, s.department_id, o.fold, o.split_role, o.origin, CAST(o.origin + o.h AS DATE),
       CAST(strftime(o.origin + o.h, '%Y%m%d') AS INTEGER), o.h, 'moving_average', avg(s.units_sold)
FROM sales AS s JOIN origins AS o ON s.date <= o.origin AND s.date > o.origin - 28 GROUP BY ALL"""

TABLES["scales"] = """
SELECT item_id, store_id, fold, CASE WHEN avg(squared_step) FILTER (date > first_sale) > 0 THEN avg(squared_step) FILTER (date > first_sale) END AS scale
FROM steps JOIN (SELECT DISTINCT fold, origin FROM origins) AS o ON date <= o.origin GROUP BY ALL"""

TABLES["backtest"] = """
SELECT p.*, a.units_sold AS actual_units, c.scale, p.forecast_units - a.units_sold AS error, abs(p.forecast_units - a.units_sold) AS absolute_error
FROM forecasts AS p JOIN sales AS a ON a.item_id = p.item_id AND a.store_id = p.store_id AND a.date = p.date
     JOIN scales AS c ON c.item_id = p.item_id AND c.store_id = p.store_id AND c.fold = p.fold WHERE p.fold > 0"""

ACCURACY = """avg(abs(forecast_units - actual_units)) AS mae, sqrt(avg((forecast_units - actual_units) ** 2)) AS rmse,
 sum(abs(forecast_units - actual_units)) / nullif(sum(actual_units), 0) AS wape,
 avg(abs(forecast_units - actual_units) / actual_units) FILTER (actual_units <> 0) AS mape,
 sum(forecast_units - actual_units) / nullif(sum(actual_units), 0) AS bias,
 sqrt(avg((forecast_units - actual_units) ** 2 / scale) FILTER (scale > 0)) AS rmsse"""

TABLES["champion"] = """
SELECT model FROM backtest WHERE fold = 2 GROUP BY 1
ORDER BY sum(absolute_error) / nullif(sum(actual_units), 0) ASC NULLS LAST, avg(absolute_error), model LIMIT 1"""

TABLES["errors"] = "SELECT * FROM backtest WHERE fold < 3 AND model IN (SELECT model FROM champion)"


def _interval(rows: str, residuals: str) -> str:
    ends = {"lower_80": 0.1, "upper_80": 0.9, "lower_95": 0.025, "upper_95": 0.975}
    quantiles = ", ".join(f"quantile_cont(actual_units - forecast_units, {p}::DOUBLE) AS q_{n}" for n, p in ends.items())
    bounds = ", ".join(
        f"{'least' if n.startswith('lower') else 'greatest'}(greatest(0, r.forecast_units + q_{n}), r.forecast_units) AS {n}" for n in ends
    )
    return f"""
SELECT r.*, {bounds} FROM ({rows}) AS r JOIN (SELECT horizon AS ahead, {quantiles} FROM ({residuals}) GROUP BY 1) ON ahead = r.horizon"""


TABLES["test"] = f"""
SELECT *, actual_units BETWEEN lower_80 AND upper_80 AS covered_80, actual_units BETWEEN lower_95 AND upper_95 AS covered_95 FROM ({_interval(
    "SELECT * FROM backtest WHERE fold = 3 AND model IN (SELECT model FROM champion)",
    "SELECT * FROM backtest WHERE fold < 2 AND model IN (SELECT model FROM champion)")})"""

TABLES["future"] = _interval(
    "SELECT p.* EXCLUDE (fold, split_role), c.scale FROM forecasts AS p JOIN scales AS c ON c.item_id = p.item_id AND c.store_id = p.store_id AND c.fold = p.fold WHERE p.fold = 0 AND p.model IN (SELECT model FROM champion)",
    "SELECT * FROM errors")

TABLES["history_pretest"] = history("(SELECT origin FROM folds WHERE fold = 3)")
TABLES["segments_pretest"] = segmented("history_pretest")

# --- inventory ----------------------------------------------------------------------------------

def draw(modulus: int, *parts: str) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8)) AS BIGINT) % {modulus}"


def normal_cdf(x: str) -> str:
    """Hart's approximation as in `shelfline.functions.columns`."""
    from shelfline.functions import columns as c

    def polynomial(coefficients) -> str:
        text = f"{coefficients[0]!r}::DOUBLE"
        for k in coefficients[1:]:
            text = f"({text} * {a} + {k!r}::DOUBLE)"
        return text

    a = f"abs({x})"
    tail = f"({a} + 0.65::DOUBLE)"
    for k in ("4.0", "3.0", "2.0", "1.0"):
        tail = f"({a} + {k}::DOUBLE / {tail})"
    upper = (
        f"CASE WHEN {a} > 37 THEN 0.0::DOUBLE WHEN {a} < 7.071::DOUBLE THEN exp(-{a} * {a} / 2) * {polynomial(c._NUMERATOR)} / {polynomial(c._DENOMINATOR)} "
        f"ELSE exp(-{a} * {a} / 2) / {tail} / 2.506628274631::DOUBLE END"
    )
    return f"(CASE WHEN {x} > 0 THEN 1.0::DOUBLE - {upper} ELSE {upper} END)"


def assumptions(history_table: str) -> str:
    return f"""
SELECT item_id, store_id, 'SUP_' || category_id AS supplier_id, CAST(3 + {draw(8, 'item_id', 'store_id', "'42'")} AS DOUBLE) AS average_lead_time_days,
       1.5::DOUBLE AS lead_time_standard_deviation, 25.0::DOUBLE AS ordering_cost_per_order, 0.25::DOUBLE AS annual_holding_cost_rate,
       CASE WHEN last_price IS NOT NULL THEN greatest(0.01::DOUBLE, last_price * 0.65::DOUBLE) END AS estimated_unit_cost, 0.95::DOUBLE AS target_service_level,
       ceil(average_daily_demand * 14) AS initial_inventory, 7.0::DOUBLE AS review_period_days, last_price * 0.4::DOUBLE AS lost_sale_penalty,
       6.0::DOUBLE AS minimum_order_quantity, 6.0::DOUBLE AS case_pack_size, 'simulated' AS assumption_type, 42 AS seed
FROM {history_table}"""


def lot(q: str) -> str:
    return f"(CASE WHEN {q} > 0 THEN ceil(greatest({q}, minimum_order_quantity) / case_pack_size) * case_pack_size ELSE 0.0::DOUBLE END)"


def policy(history_table: str, forecast_table: str, as_of: str, cases: str) -> str:
    scaled = ", ".join(
        f"a.{c} * CASE WHEN k.sensitivity_factor = '{c}' THEN k.multiplier ELSE 1.0::DOUBLE END AS {c}"
        for c in ("average_lead_time_days", "lead_time_standard_deviation", "annual_holding_cost_rate", "ordering_cost_per_order", "lost_sale_penalty")
    )
    return f"""
SELECT * EXCLUDE (sigma, protection_sigma), expected_lead_time_demand + safety_stock AS reorder_point,
       CASE WHEN sigma > 0 THEN 1.0::DOUBLE - {normal_cdf('((initial_inventory - expected_lead_time_demand) / sigma)')}
            ELSE CAST(initial_inventory < expected_lead_time_demand AS INTEGER) END AS stockout_probability,
       CASE WHEN initial_inventory < order_up_to_level THEN {lot('greatest(eoq, order_up_to_level - initial_inventory)')} ELSE 0.0::DOUBLE END AS recommended_order_quantity,
       greatest(0.0::DOUBLE, initial_inventory - order_up_to_level) AS excess_units,
       greatest(0.0::DOUBLE, initial_inventory - order_up_to_level) * estimated_unit_cost AS excess_value
FROM (SELECT *, z * sigma AS safety_stock, mu * average_lead_time_days AS expected_lead_time_demand, z * protection_sigma AS protection_safety_stock,
             mu * (average_lead_time_days + review_period_days) + z * protection_sigma AS order_up_to_level,
             sqrt(2 * (mu * 365) * ordering_cost_per_order / (estimated_unit_cost * annual_holding_cost_rate)) AS eoq,
             initial_inventory / nullif(mu, 0) AS days_of_supply, initial_inventory * estimated_unit_cost AS inventory_value, mu AS forecast_daily_demand
      FROM (SELECT *, sqrt(average_lead_time_days * demand_uncertainty_std ** 2 + mu ** 2 * lead_time_standard_deviation ** 2) AS sigma,
                   sqrt((average_lead_time_days + review_period_days) * demand_uncertainty_std ** 2 + mu ** 2 * lead_time_standard_deviation ** 2) AS protection_sigma
            FROM (SELECT h.*, {as_of} AS as_of_date, k.scenario, k.sensitivity_factor, k.multiplier, {scaled}, a.supplier_id, a.estimated_unit_cost, a.initial_inventory,
                         a.review_period_days, a.minimum_order_quantity, a.case_pack_size, l.target_service_level, l.z, f.mu,
                         coalesce(e.sd * CASE WHEN k.sensitivity_factor = 'forecast_error' THEN k.multiplier ELSE 1.0::DOUBLE END, h.demand_std) AS demand_uncertainty_std
                  FROM {history_table} AS h JOIN ({assumptions(history_table)}) AS a ON a.item_id = h.item_id AND a.store_id = h.store_id
                       JOIN (SELECT item_id, store_id, avg(forecast_units) AS mu FROM {forecast_table} GROUP BY 1, 2) AS f ON f.item_id = h.item_id AND f.store_id = h.store_id
                       LEFT JOIN (SELECT item_id, store_id, stddev_samp(error) AS sd FROM errors GROUP BY 1, 2) AS e ON e.item_id = h.item_id AND e.store_id = h.store_id,
                       (SELECT unnest([0.9, 0.95, 0.98])::DOUBLE AS target_service_level, unnest([1.2815515655446008, 1.6448536269514715, 2.053748910631822])::DOUBLE AS z) AS l,
                       ({cases}) AS k)))"""


BASE_CASE = "SELECT 'base' AS scenario, 'none' AS sensitivity_factor, 1.0::DOUBLE AS multiplier"
GRID = BASE_CASE + "".join(
    f" UNION ALL SELECT '{n}_{f}', '{n}', {f}::DOUBLE"
    for n in ("average_lead_time_days", "lead_time_standard_deviation", "annual_holding_cost_rate", "ordering_cost_per_order", "forecast_error", "lost_sale_penalty")
    for f in (0.5, 1.5)
)
TABLES["assumptions_now"] = assumptions("history_now")
TABLES["policy_now"] = policy("history_now", "future", "(SELECT hi FROM bounds)", BASE_CASE)
_TEST_ORIGIN = "(SELECT origin FROM folds WHERE fold = 3)"
TABLES["policy_pretest"] = policy("history_pretest", "test", _TEST_ORIGIN, BASE_CASE)
TABLES["policy_grid"] = policy("history_pretest", "test", _TEST_ORIGIN, GRID)


def replay_days(policy_table: str) -> str:
    """One row per world and day, with the lead time of an order placed that day and its target."""
    z = f"(({draw(4001, 'item_id', 'store_id', 'run_id', 'day')}) / 2000.0::DOUBLE - 1.0::DOUBLE) * 1.7320508075688772::DOUBLE"
    return f"""
SELECT w.* EXCLUDE (ahead), t.day, t.date, CAST(t.actual_units AS DOUBLE) AS demand, t.forecast_units AS pred,
       CAST(greatest(1, round_even(w.average_lead_time_days + w.lead_time_standard_deviation * u.z, 0)) AS INTEGER) AS lead,
       CASE WHEN w.policy = 'baseline' THEN w.average_daily_demand * 14
            ELSE coalesce(list_sum(list_slice(s.preds, t.day + 2, t.day + 1 + ahead)), 0.0::DOUBLE)
                 + (ahead - greatest(0, least(ahead, 27 - t.day))) * s.preds[28] + w.protection_safety_stock END AS target
FROM (SELECT *, CAST(ceil(average_lead_time_days + review_period_days) AS INTEGER) AS ahead FROM {policy_table},
             (SELECT CAST(unnest(range(0, 3)) AS INTEGER) AS run_id), (SELECT unnest(['baseline', 'optimized']) AS policy)) AS w
     JOIN (SELECT *, CAST(date_diff('day', origin, date) - 1 AS INTEGER) AS day FROM test) AS t ON t.item_id = w.item_id AND t.store_id = w.store_id
     JOIN (SELECT item_id, store_id, list(forecast_units ORDER BY date) AS preds FROM test GROUP BY 1, 2) AS s ON s.item_id = w.item_id AND s.store_id = w.store_id
     JOIN (SELECT item_id, store_id, run_id, day, {z} AS z FROM (SELECT DISTINCT item_id, store_id FROM test),
             (SELECT CAST(unnest(range(0, 3)) AS INTEGER) AS run_id), (SELECT CAST(unnest(range(0, 28)) AS INTEGER) AS day)) AS u
       ON u.item_id = w.item_id AND u.store_id = w.store_id AND u.run_id = w.run_id AND u.day = t.day"""


WORLD = "item_id, store_id, policy, scenario, target_service_level, run_id"


def replay(days_table: str, own: str) -> str:
    """The daily fold: state of the previous day joined to the next day of the same world."""
    names = [c.strip() for c in WORLD.split(",")]
    match = " AND ".join(f"x.{c} = r.{c}" for c in names)
    order = f"""CASE WHEN day % review_period_days <> 0 THEN 0.0::DOUBLE WHEN policy = 'baseline' THEN {lot('(target - position)')}
                WHEN position < target THEN {lot('greatest(eoq, target - position)')} ELSE 0.0::DOUBLE END"""
    return f"""
SELECT {WORLD}, -1 AS day, initial_inventory AS closing_inventory, 0.0::DOUBLE AS in_transit_units, false AS lost_since, false AS started,
       CAST(list_transform(range(0, 28), lambda v: 0) AS DOUBLE[]) AS due, 0.0::DOUBLE AS opening_inventory, 0.0::DOUBLE AS arrivals,
       0.0::DOUBLE AS fulfilled_units, 0.0::DOUBLE AS lost_sales_units, 0.0::DOUBLE AS order_quantity, 0 AS completed_cycles, 0 AS successful_cycles
FROM {days_table} WHERE day = 0
UNION ALL -- step
SELECT {WORLD}, day, stock - served, transit + q, (CASE WHEN came > 0 THEN false ELSE lost_since END) OR lost > 0, was_started OR came > 0,
       list_transform(due, lambda v, i: CASE WHEN i = day + 1 + lead THEN v + q ELSE v END), opening, came, served, lost, q,
       CAST(came > 0 AND was_started AS INTEGER), CAST(came > 0 AND was_started AND NOT lost_since AS INTEGER)
FROM (SELECT *, {order} AS q
      FROM (SELECT *, stock - served + transit AS position
            FROM (SELECT *, least(stock, demand) AS served, demand - least(stock, demand) AS lost
                  FROM (SELECT x.*, r.due, r.lost_since, r.started AS was_started, r.closing_inventory AS opening, r.due[x.day + 1] AS came,
                               r.closing_inventory + r.due[x.day + 1] AS stock, r.in_transit_units - r.due[x.day + 1] AS transit
                        FROM {own} AS r JOIN {days_table} AS x ON {match} AND x.day = r.day + 1))))"""


def ledger(days_table: str, steps_table: str) -> str:
    names = [c.strip() for c in WORLD.split(",")]
    match = " AND ".join(f"x.{c} = r.{c}" for c in names)
    return f"""
SELECT *, holding_cost + ordering_cost + lost_sale_cost AS total_inventory_cost FROM (
  SELECT r.* EXCLUDE (day, due, lost_since, started), x.date, x.pred AS forecast_demand, x.demand AS actual_demand, x.sensitivity_factor, x.multiplier,
         CAST(r.lost_sales_units > 0 AS INTEGER) AS stockout_event, r.closing_inventory * x.estimated_unit_cost * x.annual_holding_cost_rate / 365 AS holding_cost,
         CASE WHEN r.order_quantity > 0 THEN x.ordering_cost_per_order ELSE 0.0::DOUBLE END AS ordering_cost,
         r.lost_sales_units * x.lost_sale_penalty AS lost_sale_cost, r.lost_sales_units * x.last_price AS lost_sales_value
  FROM {steps_table} AS r JOIN {days_table} AS x ON {match} AND x.day = r.day)"""


def kpis(ledger_table: str) -> str:
    return f"""
SELECT k.*, k.fulfilled_units / nullif(k.actual_demand, 0) AS fill_rate, k.successful_cycles::DOUBLE / nullif(k.completed_cycles, 0) AS cycle_service_level,
       k.fulfilled_units / nullif(k.average_inventory, 0) * 365 / k.days AS inventory_turnover, b.total_inventory_cost AS baseline_cost,
       b.lost_sales_value AS baseline_lost_sales_value, b.total_inventory_cost - k.total_inventory_cost AS estimated_cost_reduction,
       b.lost_sales_value - k.lost_sales_value AS estimated_revenue_protected
FROM {ledger_table}_sums AS k JOIN {ledger_table}_sums AS b ON b.policy = 'baseline' AND b.item_id = k.item_id AND b.store_id = k.store_id
     AND b.scenario = k.scenario AND b.target_service_level = k.target_service_level AND b.run_id = k.run_id"""


def kpi_sums(ledger_table: str) -> str:
    return f"""
SELECT {WORLD}, any_value(sensitivity_factor) AS sensitivity_factor, any_value(multiplier) AS multiplier, sum(actual_demand) AS actual_demand,
       sum(fulfilled_units) AS fulfilled_units, sum(lost_sales_units) AS lost_sales_units, sum(lost_sales_value) AS lost_sales_value,
       avg(closing_inventory) AS average_inventory, max(closing_inventory) AS maximum_inventory, CAST(sum(stockout_event) AS BIGINT) AS stockout_days,
       sum(holding_cost) AS holding_cost, sum(ordering_cost) AS ordering_cost, sum(lost_sale_cost) AS lost_sale_cost,
       sum(total_inventory_cost) AS total_inventory_cost, CAST(sum(completed_cycles) AS BIGINT) AS completed_cycles,
       CAST(sum(successful_cycles) AS BIGINT) AS successful_cycles, count(*) AS days FROM {ledger_table} GROUP BY {WORLD}"""


for _name, _policy in (("ledger", "policy_pretest"), ("grid_ledger", "policy_grid")):
    TABLES[f"{_name}_days"] = replay_days(_policy)
    TABLES[f"{_name}_steps"] = replay(f"{_name}_days", f"{_name}_steps")
    TABLES[_name] = f"SELECT * FROM ({ledger(f'{_name}_days', f'{_name}_steps')}) AS whole WHERE date IS NOT NULL"
    TABLES[f"{_name}_sums"] = kpi_sums(_name)
    TABLES[f"{_name}_kpis"] = kpis(_name)

# --- learned models -----------------------------------------------------------------------------

TABLES["training"] = """
SELECT * FROM features WHERE date <= (SELECT origin FROM folds WHERE fold = 3) AND date > (SELECT origin FROM folds WHERE fold = 3) - 365
  AND lag_56 IS NOT NULL"""
