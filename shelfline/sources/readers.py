"""File sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.columns import snake_case
from shelfline.operators.quality import require_columns, require_none, stop_unless
from shelfline.sources import schemas

# The columns of the order-line source that may enter analysis. Everything else,
# customer identity above all, is dropped while reading.
ORDER_COLUMNS = (
    "order_id", "order_item_id", "order_date_dateorders", "shipping_date_dateorders",
    "days_for_shipping_real", "days_for_shipment_scheduled", "late_delivery_risk", "delivery_status",
    "shipping_mode", "market", "order_region", "category_name", "customer_segment", "product_name",
    "order_item_product_price", "order_item_quantity", "order_item_total", "sales",
    "benefit_per_order", "order_profit_per_order", "order_item_profit_ratio", "order_status",
    "product_card_id",
)
REPEATED = "order lines: null or repeated key ('order_item_id',)"
# The columns of the interactive order analysis, by raw header.
COHORT_COLUMNS = {
    "Order Id": "order_id", "Order Item Id": "order_item_id", "order date (DateOrders)": "order_date",
    "Days for shipping (real)": "actual_days", "Days for shipment (scheduled)": "scheduled_days",
    "Shipping Mode": "shipping_mode", "Market": "market", "Order Region": "region",
    "Category Name": "category", "Customer Segment": "segment", "Product Name": "product",
    "Order Item Quantity": "quantity", "Order Item Total": "revenue", "Benefit per order": "profit",
    "Order Status": "status",
}
# Sales files in order of preference.
SALES_FILES = ("sales_train_evaluation.csv", "sales_train_validation.csv")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """CSV with a header. Types come from `schema`, or from the whole file when there is none."""
    reader = spark.read.option("header", True).options(**options)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def choose_sales_file(spark: SparkSession, folder: str) -> str:
    """The evaluation file where there is one, otherwise the validation file."""
    for name in SALES_FILES:
        if path_exists(spark, f"{folder}/{name}"):
            return f"{folder}/{name}"
    raise FileNotFoundError(f"none of {', '.join(SALES_FILES)} in {folder}")


def read_panel(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(wide daily units, calendar, weekly prices). The wide file has one column per day, so its
    types are inferred; the other two have a declared schema matched by header."""
    wide = read_csv(spark, choose_sales_file(spark, folder))
    named = lambda name, schema: read_csv(spark, f"{folder}/{name}").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    )
    for name in ("calendar.csv", "sell_prices.csv"):
        if not path_exists(spark, f"{folder}/{name}"):
            raise FileNotFoundError(f"{folder}/{name}")
    return wide, named("calendar.csv", schemas.CALENDAR), named("sell_prices.csv", schemas.PRICES)


def header_names(df: DataFrame) -> list[str]:
    """Normalised column names, computed by the same expression that normalises values."""
    one = df.sparkSession.range(1)
    row = one.select(*[snake_case(F.lit(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return list(row)


def admit_order_columns(df: DataFrame, aliases: Mapping[str, str] | None = None) -> tuple[DataFrame, list[str]]:
    """Normalise headers, drop every column that is not admitted, trim text.
    Returns the lines and the names of the dropped columns."""
    names = [(aliases or {}).get(n, n) for n in header_names(df)]
    if len(set(names)) < len(names):
        raise ValueError("two columns have the same normalised name")
    renamed = df.toDF(*names)
    text = {f.name for f in renamed.schema if isinstance(f.dataType, T.StringType)}
    admitted = [c for c in names if c in ORDER_COLUMNS]
    lines = renamed.select(*[F.trim(c).alias(c) if c in text else F.col(c) for c in admitted])
    return lines, sorted(set(names) - set(ORDER_COLUMNS))


def read_order_lines(
    spark: SparkSession, path: str, aliases: Mapping[str, str] | None = None, encoding: str = "UTF-8"
) -> tuple[DataFrame, list[str]]:
    """Order-line CSV as text columns; the transform gives them their types."""
    raw = spark.read.option("header", True).option("encoding", encoding).csv(path)
    return admit_order_columns(raw, aliases)


def cohort_values(raw: DataFrame, unknown: Sequence[str] = ()) -> DataFrame:
    """The fifteen columns of the interactive analysis, as a plan that stops at a number that is missing or not finite. Columns
    named in `unknown` may be empty, but not wrong."""
    require_columns(raw.columns, COHORT_COLUMNS, "order lines")
    lines = raw.select(*[F.col(f"`{old}`").alias(new) for old, new in COHORT_COLUMNS.items()])
    numbers = ("actual_days", "scheduled_days", "quantity", "revenue", "profit")
    good = F.lit(True)
    for c in ("actual_days", "scheduled_days", "revenue", "profit"):
        number = F.expr(f"try_cast({c} AS double)")
        finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
        empty = F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
        good = good & (finite | empty if c in unknown else finite)
    checked = lines.filter(stop_unless(good, "missing or non-finite number in the order lines"))
    return checked.select(*[F.expr(f"try_cast({c} AS double)").alias(c) if c in numbers else F.col(c) for c in lines.columns])


def repeated_ids(lines: DataFrame) -> DataFrame:
    """One row, `n`: the line ids that occur twice, by 128 bits of each id."""
    halves = [F.xxhash64(F.lit(seed), "order_item_id").alias(f"_{seed}") for seed in (0, 1)]
    return lines.select(*halves).groupBy("_0", "_1").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").agg(F.count(F.lit(1)).alias("n"))


def cohort_lines(raw: DataFrame, unknown: Sequence[str] = ()) -> DataFrame:
    """`cohort_values` as a plan that also stops at a line id that is null or occurs twice. Only 16 bytes of a line are shuffled
    for that, not its columns; the plan computes the lines twice."""
    lines = cohort_values(raw, unknown)
    every = repeated_ids(raw.select(F.col("`Order Item Id`").alias("order_item_id"))).scalar()  # before the rules on numbers
    return lines.filter(stop_unless(F.col("order_item_id").isNotNull() & (every == 0), REPEATED))


def unique_lines(stored: DataFrame) -> DataFrame:
    """A stored table of order lines as it is, or an error if a line id is null or occurs twice."""
    require_none(stored.filter("order_item_id is null"), REPEATED)
    require_none(repeated_ids(stored).filter("n > 0"), REPEATED)
    return stored


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet file or hive-partitioned folder."""
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_exports(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Named exports of an earlier run."""
    return {name: scan(spark, f"{folder}/{name}.parquet") for name in names}
