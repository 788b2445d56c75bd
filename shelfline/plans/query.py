"""A named query: the Spark plan and the SQL text that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfline.functions.columns import tidy
from shelfline.plans.data import Data
from shelfline.plans.oracle import with_tables


@dataclass(frozen=True)
class Query:
    name: str
    plan: Callable[[Data], DataFrame]
    sql: str | None = None
    rounded: str = ""
    """Names of the double columns both sides round for comparison."""

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.plan(Data(spark, folder))
        return df.withColumns({c: tidy(c) for c in self.rounded.split()})

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        columns = ", ".join(
            f"CASE WHEN abs({c}) >= 1e6 THEN floor({c}::DOUBLE * 1e4 + 0.5) / 1e4 "
            f"ELSE floor({c}::DOUBLE * 1e6 + 0.5) / 1e6 END AS {c}"
            for c in self.rounded.split()
        )
        replaced = f"* REPLACE ({columns})" if columns else "*"
        return with_tables(f"SELECT {replaced} FROM ({self.sql}) AS answer")
