"""Connected components of a large list of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.joins import join_counted
from shelfline.session import discard, materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1] or 0


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node it is linked with, over any number of links) for every node of `links` (a, b long).

    Every step replaces a node's links by links to the smallest node it knows, so the rows never exceed twice the links and
    the steps grow with the logarithm of the longest path. A node with very many links is joined by broadcast. Each step is
    written to the shared folder. Links of a node with itself are ignored; no links give no rows.
    """
    edges = materialize(
        links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    state = _state(edges)
    while state != before:
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("degree"))
        large = materialize(
            join_counted(both, near, "u", "degree", 2 * state[0]).filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large_star")
        size = large.count()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
        shorter = materialize(
            join_counted(large, lowest, "u", "degree", size).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "small_star")
        discard(edges, large)
        edges = shorter
        state = _state(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
