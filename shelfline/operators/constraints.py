"""Declared table constraints, checked as violation counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.quality import counted_conditions, rule_counts, unique_key_violations, unique_text_violations


@dataclass(frozen=True)
class Key:
    table: str
    columns: tuple[str, ...]
    text: bool = False
    """Whether the key is a long text that hardly two rows share."""

    @property
    def name(self) -> str:
        return f"{self.table}_key"

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return (unique_text_violations if self.text else unique_key_violations)(tables[self.table], self.columns)


@dataclass(frozen=True)
class Reference:
    table: str
    column: str
    target: str

    @property
    def name(self) -> str:
        return f"{self.table}_{self.column}_reference"

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Keys are made distinct first, so a key that many rows share is looked up once."""
        used = tables[self.table].select(self.column).filter(F.col(self.column).isNotNull()).distinct()
        return used.join(tables[self.target].select(self.column), self.column, "left_anti")


@dataclass(frozen=True)
class Check:
    table: str
    name: str
    condition: str

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """As in SQL, an unknown condition is no violation."""
        return tables[self.table].filter(f"NOT ({self.condition})")


Constraint = Key | Reference | Check

CONSTRAINTS: tuple[Constraint, ...] = (
    Key("dim_product", ("item_id",)), Key("dim_store", ("store_id",)), Key("dim_date", ("date_key",)),
    Key("sales", ("item_id", "store_id", "date_key")),
    Reference("sales", "item_id", "dim_product"), Reference("sales", "store_id", "dim_store"),
    Reference("sales", "date_key", "dim_date"),
    Check("sales", "sales_units", "units_sold >= 0"), Check("sales", "sales_price", "sell_price >= 0"),
    Key("forecast", ("item_id", "store_id", "origin", "date", "model")),
    Check("forecast", "forecast_units", "forecast_units >= 0"),
    Check("forecast", "forecast_horizon", "horizon BETWEEN 1 AND 28 AND datediff(date, origin) = horizon"),
    Check("forecast", "forecast_bounds", "lower_95 <= lower_80 AND lower_80 <= forecast_units AND forecast_units <= upper_80 AND upper_80 <= upper_95"),
    Key("policy", ("item_id", "store_id", "as_of_date", "target_service_level")),
    Check("policy", "policy_service", "target_service_level > 0 AND target_service_level < 1"),
    Check("policy", "policy_probability", "stockout_probability BETWEEN 0 AND 1"),
    Key("ledger", ("item_id", "store_id", "date", "policy", "scenario", "run_id", "target_service_level")),
    Check("ledger", "ledger_balance", "abs(opening_inventory + arrivals - fulfilled_units - closing_inventory) <= 0.00001"),
    Check("ledger", "ledger_demand", "abs(actual_demand - fulfilled_units - lost_sales_units) <= 0.00001"),
    Check("ledger", "ledger_signs", "fulfilled_units >= 0 AND lost_sales_units >= 0 AND closing_inventory >= 0 AND in_transit_units >= 0"),
    Key("lines", ("order_item_id",), text=True), Key("delivery", ("order_id",)), Reference("lines", "order_id", "delivery"),
    Check("delivery", "delivery_late_flag", "late_order IN (0, 1)"),
    Check("delivery", "delivery_delay", "positive_delay_days >= 0"),
)


def constraint_counts(tables: Mapping[str, DataFrame], constraints: Sequence[Constraint] = CONSTRAINTS) -> DataFrame:
    """(test, failures) for every constraint on a table that is given."""
    given = [c for c in constraints if c.table in tables]
    counts = [rule_counts([(c.name, c.violations(tables)) for c in given if not isinstance(c, Check)])]
    for name in dict.fromkeys(c.table for c in given if isinstance(c, Check)):  # the row rules of a table in one scan
        counts.append(counted_conditions(
            tables[name], {c.name: f"NOT ({c.condition})" for c in given if isinstance(c, Check) and c.table == name}))
    return reduce(DataFrame.unionByName, counts)


def integrity_tests(tables: Mapping[str, DataFrame], column_names: Mapping[str, Sequence[str]]) -> DataFrame:
    """The twelve integrity tests of a served run as (test, failures); each has to be zero."""
    from shelfline.operators.quality import personal_columns

    sales, forecast, policy, ledger = (tables[n] for n in ("sales", "forecast", "policy", "ledger"))
    dates = tables["dim_date"].select("date_key", F.col("date").alias("_date"))
    # One row per item and one per day: the panel is summed before it meets the dimensions.
    items = tables["dim_product"].select("item_id").distinct().withColumn("_item", F.lit(True))
    keyed = sales.groupBy("item_id", "date", "date_key").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("units_sold") < 0).alias("negative"))
    matched = keyed.join(items, "item_id", "left").join(F.broadcast(dates), "date_key", "left")
    found = {
        "negative_sales_units": F.sum("negative"),
        "sales_orphan_product": F.sum(F.when(F.col("_item").isNull(), F.col("rows")).otherwise(0)),
        "sales_orphan_date": F.sum(F.when(F.col("_date").isNull(), F.col("rows")).otherwise(0)),
        "sales_date_key_mismatch": F.sum(F.when(F.col("date") != F.col("_date"), F.col("rows")).otherwise(0)),
    }
    counted = reduce(DataFrame.unionByName, [
        matched.agg(*[F.coalesce(v, F.lit(0).cast("long")).alias(n) for n, v in found.items()]).select(F.inline(F.array(
            *[F.struct(F.lit(n).alias("test"), F.col(n).alias("failures")) for n in found]))),
        counted_conditions(tables["sell_price"], {"negative_prices": "sell_price < 0"}),
        counted_conditions(forecast, {
            "forecast_alignment": "datediff(date, origin) <> horizon OR forecast_units < 0",
            "invalid_intervals":
                "lower_95 > lower_80 OR lower_80 > forecast_units OR upper_80 < forecast_units OR upper_95 < upper_80"}),
        counted_conditions(policy, {"invalid_service": "target_service_level <= 0 OR target_service_level >= 1"}),
        counted_conditions(ledger, {
            "inventory_balance": "abs(opening_inventory + arrivals - fulfilled_units - closing_inventory) > 0.00001",
            "invalid_fulfillment": "fulfilled_units > actual_demand OR fulfilled_units < 0"}),
        counted_conditions(tables["shipping_mode"], {"invalid_late_rate": "late_delivery_rate NOT BETWEEN 0 AND 1"}),
    ])
    personal = len(personal_columns(column_names))
    spark = sales.sparkSession
    return counted.unionByName(
        spark.range(1).select(F.lit("personal_columns").alias("test"), F.lit(personal).cast("long").alias("failures"))
    )
