"""From raw documents to token ids: toxic documents and copies go, sources are mixed, texts are encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import stages

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.toxicity),
    ("exact_dedup", stages.exact),
    ("near_dedup", stages.near),
    ("mixing", stages.mixed),
    ("encoding", stages.encoded),
]

#: Trained models decide in the first stage, so SQL can't say the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stages.reread(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
