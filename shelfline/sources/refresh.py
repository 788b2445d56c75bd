"""Incremental refresh of the monthly sales table.

The panel is stored by store and year. A log beside the monthly table holds the state (files, bytes, newest change) that each of
these partitions had when its months were last computed. A refresh compares the log with the folder, computes the months of the
partitions that are new or differ, replaces only their partitions of the monthly table, and writes the log last: a refresh that
ends in between is simply done again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.columns import month_start
from shelfline.session import files_of
from shelfline.sources import schemas

KEYS = ("store_id", "year")
_LOG = "store_id string, year int, files long, bytes long, changed long"


def partition_states(spark: SparkSession, folder: str) -> DataFrame:
    """One row per partition of a panel stored by store and year: files, bytes and the newest change. The driver lists folders,
    as many as there are stores times years."""
    path, files = files_of(spark, folder)
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    rows = []
    for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "store_id=*/year=*")) or []:
        year, store = status.getPath().getName(), status.getPath().getParent().getName()
        parts = [p for p in files.listStatus(status.getPath()) if not p.getPath().getName().startswith(("_", "."))]
        rows.append((unescape(store.split("=", 1)[1]), int(year.split("=", 1)[1]), len(parts), sum(p.getLen() for p in parts),
                     max((p.getModificationTime() for p in parts), default=0)))
    return spark.createDataFrame(rows, _LOG)


def monthly_sales(sales: DataFrame) -> DataFrame:
    """Units and revenue per month, category, state and store."""
    return sales.groupBy(month_start("date").alias("month"), "category_id", "state_id", "store_id", "year").agg(
        F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue"))


def refresh_monthly(spark: SparkSession, sales_folder: str, target: str) -> list[tuple[str, int]]:
    """Brings the monthly table in `target` up to date and returns the (store, year) partitions that were computed. Partitions that
    the panel no longer has are removed."""
    now = partition_states(spark, sales_folder)
    place, files = files_of(spark, f"{target}/_log")
    logged = spark.read.schema(_LOG).parquet(f"{target}/_log") if files.exists(place) else spark.createDataFrame([], _LOG)
    changed = [(r["store_id"], r["year"]) for r in now.exceptAll(logged).select(*KEYS).collect()]
    gone = [(r["store_id"], r["year"]) for r in logged.join(now, list(KEYS), "left_anti").select(*KEYS).collect()]
    if not changed and not gone:
        return []
    if changed:
        # Literals, so that the scan reads the changed folders alone.
        some = F.lit(False)
        for store in dict.fromkeys(s for s, _ in changed):
            some = some | ((F.col("store_id") == store) & F.col("year").isin([y for s, y in changed if s == store]))
        sales = spark.read.schema(schemas.SALES).parquet(sales_folder).filter(some)
        monthly_sales(sales).hint("rebalance", *KEYS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *KEYS).parquet(target)
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for store, year in gone:
        old, _ = files_of(spark, f"{target}/store_id={escape(store)}/year={year}")
        files.delete(old, True)
    now.coalesce(1).write.mode("overwrite").parquet(f"{target}/_log")
    return sorted(changed)


def read_monthly(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(
        "month date, category_id string, state_id string, units_sold long, revenue double, store_id string, year int").parquet(target).drop("year")
