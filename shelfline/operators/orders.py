"""Order lines: cleaning, line facts, one delivery row per order, and the summaries over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import date_key, holds, month_start, ratio
from shelfline.operators.quality import (
    QualityError, conflicting_groups, require_columns, require_none, require_unique, stop_unless,
)
from shelfline.settings import DEFAULTS, Settings

# Order states that exclude an order from delivery rates.
EXCLUDED_STATUS = ("canceled", "cancelled", "suspected_fraud", "suspected fraud")
# Known date formats by the shape of the text; the time of day is dropped. The shape is tested first
# because a failed parse costs far more than a match.
DATE_SHAPES = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy-M-d H:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
)

LABELS = {
    "shipping_mode": "shipping_mode", "market": "market", "order_region": "region", "category_name": "category",
    "customer_segment": "customer_segment", "product_name": "product_name", "order_status": "order_status",
}
ORDER_ATTRIBUTES = (
    "order_date", "shipping_mode", "market", "region", "customer_segment", "actual_shipping_days",
    "scheduled_shipping_days", "delivery_eligible", "late_order", "delay_days", "positive_delay_days",
)
LINE_COLUMNS = (
    "order_item_id", "order_id", "order_date", "date_key", "shipping_mode", "market", "region", "category",
    "customer_segment", "product_name", "quantity", "sales", "profit", "invalid_sales_flag",
    "abnormal_profit_flag", "profit_margin", "loss_making_line",
)
DELIVERY_DIMENSIONS = ("shipping_mode", "market", "region", "customer_segment")
PROFIT_DIMENSIONS = ("category", "market", "region", "product_name", "customer_segment")
# Sums of a segment in one task of `segment_profit`.
SUM_CELLS = 512


def normal_label(raw: DataFrame, name: str, mapping: Mapping[str, str] | None = None) -> Column:
    """Text label in lower case without outer blanks; a missing value or column is `unknown`."""
    value = F.col(name).cast("string") if name in raw.columns else F.lit(None).cast("string")
    label = F.lower(F.trim(F.coalesce(value, F.lit("unknown"))))
    if mapping:
        pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
        label = F.coalesce(pairs[label], label)
    return label


def parsed_date(raw: DataFrame, name: str) -> Column:
    """The date a text holds in any of the known formats, else null."""
    return parsed_date_of(name) if name in raw.columns else F.lit(None).cast("date")


def parsed_date_of(name: str) -> Column:
    text = F.trim(F.col(name).cast("string"))
    parsed = F.lit(None).cast("timestamp")
    for shape, pattern in reversed(DATE_SHAPES):
        parsed = F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(pattern))).otherwise(parsed)
    return parsed.cast("date")


def number(raw: DataFrame, name: str) -> Column:
    """The number a text holds, else null."""
    return F.expr(f"try_cast(`{name}` AS double)") if name in raw.columns else F.lit(None).cast("double")


def clean_lines(raw: DataFrame, settings: Settings = DEFAULTS, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Typed and flagged lines. Every step is a projection; nothing is shuffled."""
    require_columns(raw.columns, ["order_id", "order_item_id", "order_date_dateorders"], "order lines")
    typed = raw.select(
        "order_item_id", "order_id",
        *[normal_label(raw, old, mapping).alias(new) for old, new in LABELS.items()],
        parsed_date(raw, "order_date_dateorders").alias("order_date"),
        parsed_date(raw, "shipping_date_dateorders").alias("shipping_date"),
        number(raw, "days_for_shipping_real").alias("actual_shipping_days"),
        number(raw, "days_for_shipment_scheduled").alias("scheduled_shipping_days"),
        number(raw, "order_item_quantity").alias("quantity"),
        number(raw, settings.net_sales_source).alias("sales"),
        number(raw, settings.profit_source).alias("profit"),
        number(raw, "late_delivery_risk").alias("source_late_flag"),
    )
    actual, scheduled = F.col("actual_shipping_days"), F.col("scheduled_shipping_days")
    longest = settings.maximum_shipping_days
    flagged = typed.withColumns({
        "date_key": date_key("order_date"),
        "invalid_sales_flag": holds(F.col("sales") < 0) | holds(F.col("quantity") < 0),
        "abnormal_profit_flag": holds(F.abs("profit") > F.abs("sales") * 2),
        "delivery_eligible": holds(actual.between(0, longest) & scheduled.between(0, longest))
        & ~F.col("order_status").isin(*EXCLUDED_STATUS),
        "date_duration_mismatch": holds(F.abs(F.datediff("shipping_date", "order_date") - actual) > 1),
        "profit_margin": ratio("profit", "sales"),
        "loss_making_line": holds(F.col("profit") < 0),
    })
    delay = F.when(F.col("delivery_eligible"), actual - scheduled)
    return flagged.withColumn("delay_days", delay).withColumns({
        "late_order": (F.col("delay_days") > 0).cast("int"),
        "positive_delay_days": F.when(F.col("delay_days").isNotNull(), F.greatest("delay_days", F.lit(0.0))),
    })


def quality_counts(lines: DataFrame) -> DataFrame:
    """(issue, rows) over cleaned lines."""
    counts = lines.agg(
        F.count(F.lit(1)).alias("source_rows"),
        (F.count("order_id") - F.count_distinct("order_id")).alias("repeated_order_ids"),
        F.count_if(F.col("order_date").isNull()).alias("invalid_order_date"),
        F.count_if(F.col("shipping_date").isNull()).alias("invalid_shipping_date"),
        # An unreadable source flag disagrees with every outcome.
        F.count_if(
            F.col("delivery_eligible") & F.coalesce(F.col("source_late_flag") != F.col("late_order"), F.lit(True))
        ).alias("late_flag_disagreement"),
        F.count_if("invalid_sales_flag").alias("invalid_sales_rows"),
        F.count_if("abnormal_profit_flag").alias("abnormal_profit_rows"),
        F.count_if(~F.col("delivery_eligible")).alias("ineligible_delivery_rows"),
        F.count_if("date_duration_mismatch").alias("date_duration_mismatch"),
    )
    return counts.unpivot([], counts.columns, "issue", "rows")


def line_facts(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*LINE_COLUMNS)


def one_row_per_order(cleaned: DataFrame) -> DataFrame:
    """Delivery facts. The attributes agree within an order (see `order_conflicts`), so the distinct
    rows are one per order; they combine before the shuffle however many lines an order has."""
    return cleaned.select("order_id", *ORDER_ATTRIBUTES, "date_key").distinct()


def order_conflicts(cleaned: DataFrame) -> DataFrame:
    return conflicting_groups(cleaned, "order_id", ORDER_ATTRIBUTES)


def transform_orders(
    raw: DataFrame, settings: Settings = DEFAULTS, mapping: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(line facts, delivery facts) after every check has passed. Lines without an order id are rejected."""
    cleaned = clean_lines(raw, settings, mapping)
    require_unique(raw, ["order_item_id"], "order lines")
    require_none(cleaned.filter(F.col("order_id").isNull()), "order line without an order id")
    require_none(cleaned.filter(F.col("order_date").isNull()), "invalid order date")
    conflicts = order_conflicts(cleaned).count()
    if conflicts:
        raise QualityError(f"{conflicts} orders have conflicting shipment attributes")
    return line_facts(cleaned), one_row_per_order(cleaned)


# --- delivery -----------------------------------------------------------------------------------

def in_segments(df: DataFrame, dimensions: tuple[str, ...]) -> DataFrame:
    """Every row once per dimension, as (dimension, segment); one scan for all dimensions. The
    aggregation that follows combines before its shuffle, so the copies stay inside the task."""
    cells = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("segment")) for c in dimensions])
    return df.select("*", F.inline(cells))


def late_measures() -> dict[str, Column]:
    """Delivery measures over the eligible orders of a group."""
    eligible = F.col("delivery_eligible")
    return {
        "total_orders": F.count(F.lit(1)),
        "eligible_orders": F.count_if(eligible),
        "late_orders": F.coalesce(F.sum(F.when(eligible, F.col("late_order"))), F.lit(0)),
        "late_delivery_rate": F.avg(F.when(eligible, F.col("late_order"))),
        "average_delay_days": F.avg(F.when(eligible, F.col("positive_delay_days"))),
        "average_signed_delay": F.avg(F.when(eligible, F.col("delay_days"))),
        "actual_shipping_days": F.avg(F.when(eligible, F.col("actual_shipping_days"))),
        "scheduled_shipping_days": F.avg(F.when(eligible, F.col("scheduled_shipping_days"))),
    }


def delivery_summary(delivery: DataFrame) -> DataFrame:
    return in_segments(delivery, DELIVERY_DIMENSIONS).groupBy("dimension", "segment").agg(
        *[c.alias(n) for n, c in late_measures().items()]
    )


def order_categories(lines: DataFrame) -> DataFrame:
    return lines.select("order_id", "category").distinct()


def category_delivery(lines: DataFrame, delivery: DataFrame) -> DataFrame:
    """Delivery per category over distinct order-category pairs: an order counts once in each of its
    categories, so the rows do not add up to the number of orders."""
    pairs = order_categories(lines).join(delivery.select("order_id", "delivery_eligible", "late_order"), "order_id")
    return pairs.groupBy("category").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if("delivery_eligible").alias("eligible_orders"),
        F.coalesce(F.sum("late_order"), F.lit(0)).alias("late_orders"),
    ).withColumn("late_delivery_rate", ratio("late_orders", "eligible_orders"))


# --- profit -------------------------------------------------------------------------------------

def valid(lines: DataFrame) -> DataFrame:
    return lines.filter(~F.col("invalid_sales_flag"))


def profit_summary(lines: DataFrame) -> DataFrame:
    """Sales, profit, distinct orders and margin for every segment of five dimensions."""
    segments = in_segments(valid(lines).select("order_id", "sales", "profit", *PROFIT_DIMENSIONS), PROFIT_DIMENSIONS)
    # First one row per segment and order, so that counting orders needs no second shuffle of the
    # lines and a large segment is spread over its orders.
    per_order = segments.groupBy("dimension", "segment", "order_id").agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit")
    )
    return per_order.groupBy("dimension", "segment").agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit"),
        F.count("order_id").alias("order_count"),
    ).withColumn("profit_margin", ratio("profit", "sales"))


def segment_profit(lines: DataFrame, dimensions: tuple[str, ...] = PROFIT_DIMENSIONS) -> DataFrame:
    """`profit_summary` without the number of orders, which takes a row per segment and order; sums alone combine before the shuffle.

    Lines are added up in cells first: one sum of doubles over millions of lines is off by cents.
    """
    cell = F.pmod(F.hash("sales", "profit"), F.lit(SUM_CELLS)).alias("_cell")
    segments = in_segments(valid(lines).select("sales", "profit", *dimensions), dimensions)
    totals = [F.sum("sales").alias("sales"), F.sum("profit").alias("profit")]
    return segments.groupBy("dimension", "segment", cell).agg(*totals).groupBy("dimension", "segment").agg(*totals).withColumn(
        "profit_margin", ratio("profit", "sales"))


def order_profit(lines: DataFrame) -> DataFrame:
    return valid(lines).groupBy("order_id").agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit")
    ).withColumn("loss_making_order", holds(F.col("profit") < 0))


def monthly_orders(lines: DataFrame) -> DataFrame:
    """All lines, invalid ones included, by month."""
    per_order = lines.groupBy(month_start("order_date").alias("period"), "order_id").agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit")
    )
    return per_order.groupBy("period").agg(
        F.coalesce(F.sum("sales"), F.lit(0.0)).alias("sales"),
        F.coalesce(F.sum("profit"), F.lit(0.0)).alias("profit"),
        F.count("order_id").alias("orders"),
    )


# --- interactive cohort -------------------------------------------------------------------------

COHORT_FILTERS = ("market", "segment", "month")


def filter_cohort(lines: DataFrame, **wanted: str) -> DataFrame:
    """Equality filters on market, segment and month; `all` keeps everything, an unknown value is an error."""
    selected = lines.withColumn("month", F.date_format("order_date", "yyyy-MM"))
    for name, value in wanted.items():
        if name not in COHORT_FILTERS:
            raise ValueError(f"no filter named {name}")
        if value == "all":
            continue
        if not lines.withColumn("month", F.date_format("order_date", "yyyy-MM")).filter(F.col(name) == value).limit(1).count():
            raise ValueError(f"unsupported {name}: {value}")
        selected = selected.filter(F.col(name) == value)
    return selected


def shipping_conflicts(selected: DataFrame) -> DataFrame:
    """Orders of the cohort whose lines disagree on a shipping duration; nulls agree with anything."""
    return selected.groupBy("order_id").agg(
        F.min("actual_days").alias("a0"), F.max("actual_days").alias("a1"),
        F.min("scheduled_days").alias("s0"), F.max("scheduled_days").alias("s1"),
    ).filter("a0 <> a1 OR s0 <> s1")


def consistent(selected: DataFrame) -> DataFrame:
    """The cohort, as a plan that stops at an order whose lines disagree on a shipping duration; nulls agree with anything."""
    same = lambda c: F.coalesce(F.min(c) == F.max(c), F.lit(True))
    orders = selected.filter("order_id is not null").groupBy("order_id").agg((same("actual_days") & same("scheduled_days")).alias("same"))
    wrong = orders.filter(~F.col("same")).agg(F.count(F.lit(1)).alias("n"))
    return selected.filter(stop_unless(wrong.scalar() == 0, "inconsistent shipping values within an order"))


def cohort_metrics(selected: DataFrame) -> DataFrame:
    """One row: orders, revenue, profit, late orders and their share of all orders."""
    per_order = selected.groupBy("order_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("lines"),
        (F.max("actual_days") > F.max("scheduled_days")).cast("int").alias("late"),
    )
    return per_order.agg(
        F.count(F.lit(1)).alias("orders"), F.sum("lines").alias("selected_lines"),
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"),
        F.sum("late").alias("late_orders"), F.avg("late").alias("late_order_share"),
    )


def cohort_categories(selected: DataFrame) -> DataFrame:
    return selected.groupBy("category").agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"), F.sum("quantity").alias("units"),
        F.count("order_item_id").alias("lines"),
    ).withColumn("margin_pct", 100 * ratio("profit", "revenue"))


def cohort_trend(selected: DataFrame) -> DataFrame:
    return selected.groupBy("month").agg(F.sum("revenue").alias("revenue"))


def analyze_cohort(lines: DataFrame, **wanted: str) -> dict[str, DataFrame]:
    selected = consistent(filter_cohort(lines, **wanted))
    return {
        "metrics": cohort_metrics(selected), "categories": cohort_categories(selected), "trend": cohort_trend(selected),
    }
