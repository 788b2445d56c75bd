"""Writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.sources import schemas


def write_partitioned(df: DataFrame, path: str, keys: tuple[str, ...] = ("store_id", "year")) -> None:
    """Hive-partitioned Parquet. The rebalance hint gathers small partitions and splits a store
    that holds much more than the others, so neither file count nor task size follows the skew."""
    df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).parquet(path)


def export(df: DataFrame, name: str, folder: str) -> None:
    """One result as Parquet and as CSV with a header; both replace the earlier snapshot."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    saved = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}.parquet")
    saved.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")


def export_large(df: DataFrame, name: str, folder: str) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def run_metadata(spark: SparkSession, provenance: str, mode: str) -> DataFrame:
    """One row describing a run."""
    return spark.range(1).select(
        F.current_timestamp().alias("last_refresh_utc"),
        F.lit(provenance).alias("data_provenance"),
        F.lit(mode).alias("mode"),
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns `schema` names, in its order and types; a column `df` lacks becomes null."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def load_serving(
    spark: SparkSession, frames: Mapping[str, DataFrame], targets: Mapping[str, T.StructType] = schemas.SERVING
) -> list[str]:
    """Replace the content of each serving table for which there is a frame of that name."""
    loaded = []
    for target, schema in targets.items():
        if target not in frames:
            continue
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {target.split('.')[0]}")
        conform(frames[target], schema).write.mode("overwrite").format("parquet").saveAsTable(target)
        loaded.append(target)
    return loaded


def refresh_monthly_sales(monthly: DataFrame, target: str = "mart.mv_monthly_sales") -> None:
    """Rebuild the stored monthly mart."""
    spark = monthly.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target.split('.')[0]}")
    monthly.write.mode("overwrite").format("parquet").saveAsTable(target)
