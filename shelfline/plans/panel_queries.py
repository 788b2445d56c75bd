"""Queries over the retail panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions.columns import normal_cdf, snake_case
from shelfline.operators import dimensions, features, ordered, panel, quality, segments
from shelfline.plans import marts, oracle, reports
from shelfline.plans.data import Data
from shelfline.plans.query import Query
from shelfline.session import discard, materialize
from shelfline.sources import testdata

DAY = ["item_id", "store_id", "date"]
_END = "(SELECT hi FROM bounds)"


def _featured(columns):
    """Only the windows that make `columns`, so the plan carries nothing it does not show."""
    return lambda d: d.sales.withColumns(columns()).select(*DAY, *columns())


def _history(d: Data):
    return panel.history_summary(d.sales, d.today)


def _orphans(d: Data):
    """Panel rows of items that are not on offer and of days without an order."""
    keys = d.sales.groupBy("item_id", "date_key").agg(F.count(F.lit(1)).alias("rows"))
    days = testdata.order_days(d.spark, d.folder)
    flagged = keys.join(d.catalogue.withColumn("_item", F.lit(True)), "item_id", "left").join(
        days.withColumn("_day", F.lit(True)), "date_key", "left")
    return flagged.select(F.inline(F.array(
        F.struct(F.lit("sales_orphan_product").alias("test"), F.when(F.col("_item").isNull(), F.col("rows")).otherwise(0).alias("n")),
        F.struct(F.lit("sales_orphan_date").alias("test"), F.when(F.col("_day").isNull(), F.col("rows")).otherwise(0).alias("n")),
    ))).groupBy("test").agg(F.sum("n").alias("failures"))


def _best_and_worst(d: Data):
    """Highest and lowest revenue series as one row."""
    by_series = d.sales.groupBy(*panel.SERIES).agg(F.sum("revenue").alias("revenue"))
    entry = F.struct("revenue", "item_id", "store_id")
    return by_series.agg(F.max(entry).alias("hi"), F.min(entry).alias("lo")).select(
        F.col("hi.item_id").alias("best_item"), F.col("hi.store_id").alias("best_store"), F.col("hi.revenue").alias("best_revenue"),
        F.col("lo.item_id").alias("worst_item"), F.col("lo.store_id").alias("worst_store"), F.col("lo.revenue").alias("worst_revenue"),
    )


def _watched(d: Data):
    watch = quality.Watch(d.delivered, quality.PANEL_ROWS)
    discard(materialize(watch.table, "watched"))
    return watch.report(d.spark)


def _key_counts(d: Data):
    """Keys of delivered tables, which have repeated rows planted, and of dimensions, which have none."""
    return quality.key_rule_counts({
        "delivered": (d.delivered, ["item_id", "store_id", "date"]), "prices": (d.delivered_prices, ["item_id", "store_id", "wm_yr_wk"]),
        "products": (d.products, ["item_id"]), "stores": (d.stores, ["store_id"])})


def _profile(d: Data):
    return quality.table_profile(testdata.table(d.spark, d.folder, "lineitem"))


_LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
_LINE_TYPES = ("bigint", "bigint", "bigint", "int", "double", "double", "double", "double", "string", "string")


def _profile_sql() -> str:
    rows = []
    for c, t in zip(_LINE_COLUMNS, (*_LINE_TYPES, "timestamp_ntz")):
        numeric, date = t in ("bigint", "int", "double"), c == "l_shipdate"
        q1, q3 = f"quantile_cont({c}::DOUBLE, 0.25)", f"quantile_cont({c}::DOUBLE, 0.75)"
        rows.append(f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) FILTER ({c} IS NULL) AS missing,
 {f'count(*) FILTER ({c} < 0)' if numeric else 'NULL::BIGINT'} AS negative, {f'count(*) FILTER ({c} = 0)' if numeric else 'NULL::BIGINT'} AS zero,
 {f'min({c})::DOUBLE' if numeric else 'NULL::DOUBLE'} AS minimum, {f'max({c})::DOUBLE' if numeric else 'NULL::DOUBLE'} AS maximum,
 {'0::BIGINT' if date else 'NULL::BIGINT'} AS invalid_dates, {f'min({c})::DATE' if date else 'NULL::DATE'} AS date_min, {f'max({c})::DATE' if date else 'NULL::DATE'} AS date_max,
 0::BIGINT AS replacement_characters, count(DISTINCT {c}) AS unique_values,
 {f'(SELECT count(*) FROM lineitem, (SELECT {q1} AS q1, {q3} AS q3 FROM lineitem) WHERE {c} < q1 - 1.5::DOUBLE * (q3 - q1) OR {c} > q3 + 1.5::DOUBLE * (q3 - q1))' if numeric else 'NULL::BIGINT'} AS outliers_iqr,
 count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows FROM lineitem""")
    return " UNION ALL ".join(rows)


QUERIES = [
    # --- analytical queries ---
    Query("i01_monthly_revenue", lambda d: panel.sales_by(d.sales, panel.month_start("date"), "month"),
          "SELECT CAST(date_trunc('month', date) AS DATE) AS month, CAST(sum(units_sold) AS BIGINT) AS units_sold, sum(revenue) AS revenue FROM sales GROUP BY 1",
          "revenue"),
    Query("i02_monthly_growth", lambda d: reports.monthly_growth(d.sales),
          """SELECT month, revenue, revenue / nullif(lag(revenue) OVER (ORDER BY month), 0) - 1 AS mom_growth
             FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month, sum(revenue) AS revenue FROM sales GROUP BY 1)""",
          "revenue mom_growth"),
    Query("i03_store_ranking", lambda d: reports.store_ranking(d.sales),
          """SELECT store_id, revenue, dense_rank() OVER (ORDER BY revenue DESC) AS rank
             FROM (SELECT store_id, sum(revenue) AS revenue FROM sales GROUP BY 1)""", "revenue"),
    Query("i04_category_contribution", lambda d: reports.category_contribution(d.sales, d.products),
          """SELECT category_id, revenue, revenue / nullif(sum(revenue) OVER (), 0) AS contribution
             FROM (SELECT p.category_id, sum(s.revenue) AS revenue FROM sales AS s JOIN dim_product AS p ON p.item_id = s.item_id GROUP BY 1)""",
          "revenue contribution"),
    Query("i05_top_items", lambda d: reports.top_items(d.sales, d.today),
          f"""SELECT item_id, sum(revenue) AS revenue FROM sales WHERE date > {_END} - 90
              GROUP BY 1 ORDER BY revenue DESC, item_id LIMIT 20""", "revenue"),
    Query("i06_bottom_items", lambda d: reports.bottom_items(d.sales),
          "SELECT item_id, sum(revenue) AS revenue FROM sales GROUP BY 1 ORDER BY revenue ASC NULLS LAST, item_id LIMIT 20",
          "revenue"),
    Query("i07_rolling_demand",
          lambda d: d.sales.select(*DAY, *[F.avg("units_sold").over(features.past(k)).alias(f"mean{k}") for k in (7, 28)]),
          "SELECT item_id, store_id, date, rolling_mean_7 AS mean7, rolling_mean_28 AS mean28 FROM features", "mean7 mean28"),
    Query("i08_variability", lambda d: reports.demand_variability(d.sales),
          """SELECT item_id, store_id, stddev_samp(units_sold) / nullif(avg(units_sold), 0) AS cv,
                    avg(CASE WHEN units_sold = 0 THEN 1.0::DOUBLE ELSE 0 END) AS zero_share FROM sales GROUP BY 1, 2""",
          "cv zero_share"),
    Query("i09_abc_by_item", lambda d: reports.abc_by_item(d.sales),
          f"SELECT item_id, revenue, share AS prior_share, {oracle.ABC_CLASS} AS abc FROM ({oracle.ahead('item_totals', 'item_id')})",
          "revenue prior_share"),
    Query("i10_xyz_by_series", lambda d: reports.xyz_by_series(d.sales),
          """SELECT item_id, store_id, CASE WHEN zeros >= 0.5 THEN 'Z' WHEN cv <= 0.5 THEN 'X' WHEN cv <= 1.0 THEN 'Y' ELSE 'Z' END AS xyz
             FROM (SELECT item_id, store_id, stddev_samp(units_sold) / nullif(avg(units_sold), 0) AS cv, avg(zero_sales_flag) AS zeros
                   FROM sales GROUP BY 1, 2)"""),
    Query("i11_abc_xyz_by_series", lambda d: reports.abc_xyz_by_series(d.sales),
          f"""SELECT item_id, store_id, revenue, cv, zero_share, share AS prior_share, {oracle.ABC_CLASS} || '-' || {oracle.XYZ_CLASS} AS abc_xyz
             FROM ({oracle.ahead('series_totals', 'item_id, store_id')})""",
          "revenue cv zero_share prior_share"),
    Query("i12_price_and_demand_changes", lambda d: reports.price_and_demand_changes(d.sales),
          """SELECT item_id, store_id, date, price_change_percentage AS price_change, units_sold - lag_1 AS demand_change,
                    lead(units_sold) OVER (PARTITION BY item_id, store_id ORDER BY date) AS next_day_units FROM features""",
          "price_change"),
    Query("i13_event_uplift", lambda d: reports.event_uplift(d.sales),
          """SELECT item_id, avg(units_sold) FILTER (event_flag = 1) / nullif(avg(units_sold) FILTER (event_flag = 0), 0) - 1 AS unadjusted_event_uplift
             FROM sales GROUP BY 1""", "unadjusted_event_uplift"),
    Query("i26_planning_calendar", lambda d: reports.planning_calendar(d.sales),
          "SELECT CAST(hi + h AS DATE) AS date, h AS horizon FROM (SELECT hi, unnest(range(1, 29))::INTEGER AS h FROM bounds)"),
    Query("i27_store_revenue_in_range", lambda d: reports.store_revenue_between(d.sales, 20000101, 20000131),
          "SELECT store_id, sum(revenue) AS revenue FROM sales WHERE date_key BETWEEN 20000101 AND 20000131 GROUP BY 1", "revenue"),
    # --- reshaping and joins ---
    Query("p01_unpivot_days", lambda d: panel.unpivot_days(d.wide).select("item_id", "store_id", "d", "units_sold"),
          "SELECT item_id, store_id, d, units_sold FROM demand"),
    Query("p02_revenue_rule", lambda d: d.sales.select(*DAY, "units_sold", "sell_price", "revenue"),
          "SELECT item_id, store_id, date, units_sold, sell_price, revenue FROM sales", "sell_price revenue"),
    Query("p03_calendar_fields", lambda d: d.sales.select(*DAY, "date_key", "weekday", "month", "quarter", "year"),
          "SELECT item_id, store_id, date, date_key, weekday, month, quarter, year FROM sales"),
    Query("p04_state_snap_flag", lambda d: d.sales.select(*DAY, "state_id", "snap_flag"),
          "SELECT item_id, store_id, date, state_id, snap_flag FROM sales"),
    Query("p05_day_flags", lambda d: d.sales.select(*DAY, "event_flag", "weekend_flag", "month_start_flag", "month_end_flag", "zero_sales_flag"),
          "SELECT item_id, store_id, date, event_flag, weekend_flag, month_start_flag, month_end_flag, zero_sales_flag FROM sales"),
    Query("p06_trailing_window", lambda d: panel.trailing(d.sales, d.today, 365).select(*DAY, "units_sold"),
          f"SELECT item_id, store_id, date, units_sold FROM sales WHERE date <= {_END} AND date > {_END} - 365"),
    Query("j01_calendar_join", lambda d: panel.join_calendar(d.demand, d.calendar).select("id", "d", "date", "wm_yr_wk", "event_name_1"),
          "SELECT m.id, m.d, c.date, c.wm_yr_wk, c.event_name_1 FROM demand AS m LEFT JOIN calendar AS c ON c.d = m.d"),
    Query("j02_price_join",
          lambda d: panel.join_prices(panel.join_calendar(d.demand, d.calendar), d.prices).select(*DAY, "wm_yr_wk", "sell_price"),
          "SELECT item_id, store_id, date, wm_yr_wk, sell_price FROM sales", "sell_price"),
    Query("j03_cohort_panel", lambda d: panel.keep_cohort(d.sales, panel.sample_cohort(d.sales)).select(*DAY, "units_sold"),
          "SELECT item_id, store_id, date, units_sold FROM sales WHERE (item_id, store_id) IN (SELECT (item_id, store_id) FROM cohort)"),
    Query("j04_series_of_top_stores", lambda d: panel.in_top_stores(panel.revenue_before_validation(d.sales), 2),
          """SELECT item_id, store_id, revenue FROM cohort_revenue WHERE store_id IN (
               SELECT store_id FROM cohort_revenue GROUP BY 1 ORDER BY sum(revenue) DESC, store_id LIMIT 2)""", "revenue"),
    Query("j11_orphans", _orphans,
          """SELECT 'sales_orphan_product' AS test, count(*) AS failures FROM sales WHERE item_id NOT IN (SELECT item_id FROM catalogue)
             UNION ALL SELECT 'sales_orphan_date', count(*) FROM sales WHERE date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)"""),
    Query("t03_best_and_worst_series", _best_and_worst,
          """SELECT b.item_id AS best_item, b.store_id AS best_store, b.revenue AS best_revenue, w.item_id AS worst_item, w.store_id AS worst_store, w.revenue AS worst_revenue
             FROM (SELECT item_id, store_id, sum(revenue) AS revenue FROM sales GROUP BY 1, 2 ORDER BY revenue DESC, item_id DESC, store_id DESC LIMIT 1) AS b,
                  (SELECT item_id, store_id, sum(revenue) AS revenue FROM sales GROUP BY 1, 2 ORDER BY revenue, item_id, store_id LIMIT 1) AS w""",
          "best_revenue worst_revenue"),
    Query("t04_training_sample",
          lambda d: features.training_sample(d.sales.select(*DAY), 5000, d.settings.seed),
          """SELECT item_id, store_id, date FROM sales
             ORDER BY md5(concat_ws('|', item_id, store_id, strftime(date, '%Y-%m-%d'), '42')) LIMIT 5000"""),
    Query("t05_sample_cohort", lambda d: panel.sample_cohort(d.sales), "SELECT item_id, store_id FROM cohort"),
    Query("t06_first_series", lambda d: panel.first_series(d.sales, 24),
          "SELECT DISTINCT item_id, store_id FROM sales ORDER BY item_id, store_id LIMIT 24"),
    # --- aggregates ---
    Query("a01_history_summary", _history, "SELECT * FROM history_now",
          "average_daily_demand demand_std revenue zero_demand_share last_price"),
    Query("a02_period_rollups", lambda d: panel.period_rollups(d.sales),
          """SELECT grain, period, CAST(sum(units_sold) AS BIGINT) AS units_sold, sum(revenue) AS revenue FROM (
               SELECT 'month' AS grain, CAST(date_trunc('month', date) AS DATE) AS period, units_sold, revenue FROM sales UNION ALL
               SELECT 'week', CAST(date_trunc('week', date) AS DATE), units_sold, revenue FROM sales UNION ALL
               SELECT 'day', date, units_sold, revenue FROM sales) GROUP BY 1, 2""", "revenue"),
    Query("a03_dimension_profiles", lambda d: panel.dimension_profiles(d.sales),
          "SELECT dimension, segment, CAST(sum(units_sold) AS BIGINT) AS units_sold, sum(revenue) AS revenue, avg(units_sold) AS mean_series_day_units, count(*) AS series_days FROM ("
          + " UNION ALL ".join(f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS segment, units_sold, revenue FROM sales" for c in panel.PROFILE_DIMENSIONS)
          + ") GROUP BY 1, 2", "revenue mean_series_day_units"),
    Query("a04_price_demand_correlation",
          lambda d: panel.price_demand_correlation(d.sales.withColumns(features.price_change())),
          """SELECT item_id, store_id, CASE WHEN sx * sy > 1e-12 THEN cov / (sx * sy) END AS price_change_demand_correlation FROM (
               SELECT item_id, store_id, covar_pop(price_change_percentage, units_sold) AS cov,
                      stddev_pop(price_change_percentage) AS sx, stddev_pop(units_sold) FILTER (price_change_percentage IS NOT NULL) AS sy
               FROM features GROUP BY 1, 2)""", "price_change_demand_correlation"),
    Query("a20_portfolio_totals",
          lambda d: d.sales.agg(F.sum("units_sold").alias("units"), F.sum("revenue").alias("revenue"), F.max("date").alias("last_date")),
          "SELECT CAST(sum(units_sold) AS BIGINT) AS units, sum(revenue) AS revenue, max(date) AS last_date FROM sales", "revenue"),
    # --- windows and segments ---
    Query("w01_lags", _featured(features.lags),
          "SELECT item_id, store_id, date, lag_1, lag_7, lag_14, lag_28, lag_56 FROM features"),
    Query("w02_rolling_means", _featured(features.rolling_means),
          "SELECT item_id, store_id, date, rolling_mean_7, rolling_mean_28, rolling_mean_56 FROM features",
          "rolling_mean_7 rolling_mean_28 rolling_mean_56"),
    Query("w03_rolling_spread_and_sums", _featured(features.rolling_spreads),
          """SELECT item_id, store_id, date, rolling_std_7, rolling_7_day_units, rolling_7_day_revenue, rolling_std_28,
                    rolling_28_day_units, rolling_28_day_revenue FROM features""",
          "rolling_std_7 rolling_7_day_revenue rolling_std_28 rolling_28_day_revenue"),
    Query("w04_price_change", _featured(features.price_change),
          "SELECT item_id, store_id, date, price_change_percentage FROM features", "price_change_percentage"),
    Query("w05_days_since_last_sale", _featured(features.days_since_last_sale),
          "SELECT item_id, store_id, date, days_since_last_sale FROM features"),
    Query("w11_average_percent_rank",
          lambda d: ordered.average_percent_ranked(_history(d).select("item_id", "store_id", "units_sold"), "units_sold", "pct_rank"),
          """SELECT item_id, store_id, units_sold, (rank() OVER (ORDER BY units_sold) + (count(*) OVER (PARTITION BY units_sold) - 1) / 2.0::DOUBLE)
                    / count(*) OVER () AS pct_rank FROM history_now""", "pct_rank"),
    Query("w12_error_scale", lambda d: features.error_scale(d.sales),
          """SELECT item_id, store_id, CASE WHEN any_value(first_sale) IS NOT NULL AND avg(step * step) FILTER (date > first_sale) > 0
                    THEN avg(step * step) FILTER (date > first_sale) END AS scale
             FROM (SELECT item_id, store_id, date, min(date) FILTER (units_sold <> 0) OVER (PARTITION BY item_id, store_id) AS first_sale,
                          units_sold - lag_1 AS step FROM features) GROUP BY 1, 2""", "scale"),
    Query("d04_segmentation", lambda d: segments.segmentation(_history(d)), "SELECT * FROM segments_now",
          "average_daily_demand demand_std revenue zero_demand_share last_price coefficient_of_variation cumulative_revenue_share"),
    # --- dimensions and marts ---
    Query("d01_dim_product", lambda d: d.products, "SELECT * FROM dim_product"),
    Query("d01_dim_store", lambda d: d.stores, "SELECT * FROM dim_store"),
    Query("d01_dim_state", lambda d: dimensions.distinct_of(d.sales, "state_id"), "SELECT DISTINCT state_id FROM sales"),
    Query("d01_dim_category", lambda d: dimensions.distinct_of(d.sales, "category_id"), "SELECT DISTINCT category_id FROM sales"),
    Query("d01_dim_department", lambda d: dimensions.distinct_of(d.sales, "department_id", "category_id"),
          "SELECT DISTINCT department_id, category_id FROM sales"),
    Query("d01_dim_event", lambda d: dimensions.dim_event(d.calendar),
          # One row per name: a name with two types would make this differ.
          """SELECT event_name, min(event_type) AS event_type FROM (
                 SELECT event_name_1 AS event_name, event_type_1 AS event_type FROM calendar WHERE event_name_1 IS NOT NULL
                 UNION ALL SELECT event_name_2, event_type_2 FROM calendar WHERE event_name_2 IS NOT NULL) GROUP BY 1"""),
    Query("d01_bridge_date_event", lambda d: dimensions.bridge_date_event(d.calendar),
          """SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, event_name_1 AS event_name FROM calendar WHERE event_name_1 IS NOT NULL
             UNION SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER), event_name_2 FROM calendar WHERE event_name_2 IS NOT NULL"""),
    Query("d01_fact_sell_price", lambda d: dimensions.fact_sell_price(d.sales),
          "SELECT DISTINCT item_id, store_id, wm_yr_wk, sell_price FROM sales WHERE sell_price IS NOT NULL", "sell_price"),
    Query("d02_dim_date", lambda d: dimensions.dim_date(d.calendar, d.lines),
          """SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(date) AS INTEGER) AS year,
                    CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter FROM calendar"""),
    Query("d08_mart_sales_performance", lambda d: marts.sales_performance(d.sales, d.products, d.stores),
          """SELECT CAST(date_trunc('month', f.date) AS DATE) AS month, p.category_id, t.state_id, f.store_id,
                    CAST(sum(f.units_sold) AS BIGINT) AS units_sold, sum(f.revenue) AS revenue
             FROM sales AS f JOIN dim_product AS p ON p.item_id = f.item_id JOIN dim_store AS t ON t.store_id = f.store_id GROUP BY ALL""",
          "revenue"),
    Query("d10_mart_product_store_performance", lambda d: marts.product_store_performance(d.sales),
          """SELECT item_id, store_id, sum(revenue) AS revenue, CAST(sum(units_sold) AS BIGINT) AS units_sold, avg(units_sold) AS mean_units,
                    stddev_samp(units_sold) / nullif(avg(units_sold), 0) AS demand_cv FROM sales GROUP BY 1, 2""",
          "revenue mean_units demand_cv"),
    # --- quality ---
    Query("q02_watched_rules", _watched,
          """SELECT 'invalid_demand_or_date' AS test, count(*) AS failures FROM delivered WHERE units_sold IS NULL OR units_sold < 0 OR date IS NULL
             UNION ALL SELECT 'sold_without_price', count(*) FROM delivered WHERE units_sold > 0 AND sell_price IS NULL"""),
    Query("q03_key_counts", _key_counts,
          """SELECT 'delivered' AS test, count(*) AS failures FROM (SELECT date FROM delivered GROUP BY item_id, store_id, date
                         HAVING count(*) > 1 OR item_id IS NULL OR store_id IS NULL OR date IS NULL)
             UNION ALL SELECT 'prices', count(*) FROM (SELECT item_id FROM delivered_prices GROUP BY item_id, store_id, wm_yr_wk
                         HAVING count(*) > 1 OR item_id IS NULL OR store_id IS NULL OR wm_yr_wk IS NULL)
             UNION ALL SELECT 'products', count(*) FROM (SELECT item_id FROM dim_product GROUP BY item_id HAVING count(*) > 1 OR item_id IS NULL)
             UNION ALL SELECT 'stores', count(*) FROM (SELECT store_id FROM dim_store GROUP BY store_id HAVING count(*) > 1 OR store_id IS NULL)"""),
    Query("q04_table_profile", _profile, _profile_sql(), "minimum maximum"),
    Query("q05_panel_source_rules",
          lambda d: quality.rule_counts(quality.panel_source_rules(d.delivered_wide, d.calendar, d.delivered_prices)),
          """SELECT 'duplicate_series' AS test, count(*) AS failures FROM (SELECT id FROM delivered_demand WHERE d = 'd_1' GROUP BY item_id, store_id, id HAVING count(*) > 1)
             UNION ALL SELECT 'duplicate_day', count(*) FROM (SELECT d FROM calendar GROUP BY d HAVING count(*) > 1)
             UNION ALL SELECT 'duplicate_date', count(*) FROM (SELECT date FROM calendar GROUP BY date HAVING count(*) > 1)
             UNION ALL SELECT 'invalid_date', count(*) FROM calendar WHERE date IS NULL
             UNION ALL SELECT 'invalid_price', count(*) FROM delivered_prices WHERE sell_price IS NULL OR sell_price < 0
             UNION ALL SELECT 'invalid_demand', count(*) FROM delivered_demand WHERE d = 'd_1' AND (units_sold IS NULL OR units_sold < 0)
             UNION ALL SELECT 'invalid_identity', count(*) FROM delivered_demand WHERE d = 'd_1' AND (item_id IS NULL OR store_id IS NULL OR state_id NOT IN ('CA', 'TX', 'WI'))
             UNION ALL SELECT 'duplicate_price', count(*) FROM (SELECT item_id FROM delivered_prices GROUP BY item_id, store_id, wm_yr_wk HAVING count(*) > 1)"""),
    Query("q06_panel_rules", lambda d: quality.panel_rule_counts(d.delivered),
          """SELECT 'invalid_demand_or_date' AS test, count(*) AS failures FROM delivered WHERE units_sold IS NULL OR units_sold < 0 OR date IS NULL
             UNION ALL SELECT 'sold_without_price', count(*) FROM delivered WHERE units_sold > 0 AND sell_price IS NULL
             UNION ALL SELECT 'repeated_day', count(*) FROM (SELECT date FROM delivered GROUP BY item_id, store_id, date HAVING count(*) > 1)
             UNION ALL SELECT 'gap_in_history', count(*) FROM (SELECT item_id FROM delivered GROUP BY item_id, store_id
                         HAVING count(*) <> date_diff('day', min(date), max(date)) + 1)"""),
    Query("q07_contiguity", lambda d: quality.contiguity(d.sales),
          "SELECT item_id, store_id, count(*) AS days, CAST(date_diff('day', min(date), max(date)) + 1 AS BIGINT) AS expected_days FROM sales GROUP BY 1, 2"),
    Query("q13_shortest_history", lambda d: quality.shortest_history(d.sales),
          "SELECT min(days) AS shortest_history FROM (SELECT count(*) AS days FROM sales GROUP BY item_id, store_id)"),
    # --- scalar functions over table columns ---
    Query("f01_snake_case",
          lambda d: testdata.table(d.spark, d.folder, "part").select("p_partkey", snake_case(F.concat_ws(" / ", "p_brand", "p_name", "p_type")).alias("label")),
          """SELECT p_partkey, trim(regexp_replace(lower(trim(concat_ws(' / ', p_brand, p_name, p_type))), '[^a-z0-9]+', '_', 'g'), '_') AS label FROM part"""),
    Query("f07_normal_cdf",
          lambda d: testdata.table(d.spark, d.folder, "customer").select("c_custkey", normal_cdf((F.col("c_acctbal") - 4500.0) / 600.0).alias("probability")),
          f"SELECT c_custkey, {oracle.normal_cdf('x')} AS probability FROM (SELECT c_custkey, (c_acctbal - 4500.0::DOUBLE) / 600.0::DOUBLE AS x FROM customer)",
          "probability"),
]
