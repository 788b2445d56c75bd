"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns the documents that go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import bpe, exact_dedup, minhash, mixing
from shelfline.llm import toxicity as chain
from shelfline.llm.queries import VOCABULARY, table
from shelfline.session import materialize


def reread(docs: DataFrame) -> DataFrame:
    """Written to the shared folder and read again."""
    return materialize(docs, "stage")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no category of the chain rejects."""
    return chain.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of all sources in the mix's proportions, repeated as often as the mix takes them."""
    return mixing.repeat(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their number."""
    return bpe.encode(docs, VOCABULARY).withColumn("n_tokens", F.size("ids").cast("long"))
