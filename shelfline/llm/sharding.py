"""Contiguous shards of near-equal bytes by global prefix sums.

Documents are ordered by (doc_id, size, crc); null ids come first. The order is cut into ranges, each range is totalled, the
totals of earlier ranges are added to a running sum inside each range, and the whole sum is cut at equal targets. Only
(doc_id, size, crc) are shuffled, never a text; equal rows are interchangeable, so it doesn't matter which comes first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.joins import packed
from shelfline.session import materialize

KEY = ("doc_id", "size", "text_crc32")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, UTF-8 bytes plus one (a null text has none), and the checksum of the text (null: of the empty text)."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))


def prefix_sums(rows: DataFrame) -> DataFrame:
    """Adds `before`, the bytes of all earlier rows, `nth`, their number, and `total`, the bytes of all rows."""
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written, so that the ranges, which Spark finds by sampling, are fixed from here on.
    ranged = materialize(rows.repartitionByRange(ranges, *KEY).withColumn("range", F.spark_partition_id()), "ranges")
    # One row per range: this window is as long as the number of partitions.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select("range", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
                F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
                F.sum("bytes").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    )
    inside = Window.partitionBy("range").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.withColumns({"_sum": F.sum("size").over(inside), "_nth": F.count("*").over(inside)})
        .join(F.broadcast(totals), "range")  # one row per range
        .select(*KEY, (F.col("bytes_before") + F.col("_sum") - F.col("size")).alias("before"),
                (F.col("rows_before") + F.col("_nth") - 1).alias("nth"), "total")
    )


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (its place in the shard, from 0).

    A document goes to the shard in whose share of the bytes its middle byte lies. Shards differ from the target by less than
    the longest document; a shard can be empty if there are fewer documents than shards. An empty table gives no rows.
    """
    placed = materialize(
        prefix_sums(sized(docs)).select(
            *KEY, "nth", F.expr(f"cast((2 * before + size) * {int(shards)} div (2 * total) as int)").alias("shard")),
        "placed")
    first = placed.groupBy("shard").agg(F.min("nth").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(*KEY, "shard", (F.col("nth") - F.col("_first")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """Writes whole documents to `path`/shard=0 ... in order. Each shard's first key decides; rows that equal it start it."""
    cuts = shard(docs, shards).filter("slot = 0").select("shard", F.struct(*KEY).alias("cut"))
    cuts = F.broadcast(cuts.agg(F.sort_array(F.collect_list(F.struct("cut", "shard"))).alias("__cuts")))  # one entry per shard
    text = F.coalesce("__row.text", F.lit(""))
    key = F.struct(
        F.col("__row.doc_id").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = packed(docs).withColumn("__key", key).join(cuts).select(
        "__row", "__key", F.element_at(F.filter("__cuts", lambda c: c["cut"] <= F.col("__key")), -1)["shard"].alias("__shard"))
    ordered = placed.repartitionByRange(shards * 4, "__shard", "__key").sortWithinPartitions("__shard", "__key")
    # The table's columns come first; the folder names the shard.
    ordered.select("__row.*", F.col("__shard").alias("shard")).write.mode("overwrite").partitionBy("shard").parquet(path)
