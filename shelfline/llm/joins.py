"""Joins and keys that hold up when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_KEYS = 2048
"""At most this many keys can each hold more than one 2048th of all rows; only they are broadcast."""


def join_counted(rows: DataFrame, table: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """`rows` joined with `table`, which has one row per key and the key's number of rows in `count`.

    Keys with more than total / HEAVY_KEYS rows are broadcast: there are fewer than HEAVY_KEYS of them at any size. The
    others are joined by a shuffle in which no key is large. Null keys join nothing. `total`: the sum of `count`.
    """
    limit = max(1, total // HEAVY_KEYS)
    heavy = F.broadcast(table.filter(F.col(count) > limit).withColumn("_heavy", F.lit(True)))
    # The first join marks the hot rows in place, so that they are not shuffled at all.
    marked = rows.join(heavy, key, "left")
    others = [c for c in table.columns if c != key]
    light_rows = marked.filter(F.col("_heavy").isNull()).drop("_heavy", *others)
    light = light_rows.join(table.filter(F.col(count) <= limit), key)
    hot = marked.filter(F.col("_heavy")).select(light.columns)
    return light.unionByName(hot)


FILTER_BITS = 1 << 24
"""Places of the filter in `may_match`: at most a 64th as many rows are broadcast, whatever the tables' size."""


def may_match(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """The rows whose `key`, a hash (long, not null), may be among `wanted_key`: all that are, and of the others as many as share a place of
    a bitmap with one. It goes before a join of wide rows, which then shuffles few that it would drop; the join itself decides.
    """
    word = lambda c: F.shiftright(F.pmod(F.col(c), F.lit(FILTER_BITS)), 6)
    place = lambda c: F.pmod(F.col(c), F.lit(64)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place(wanted_key))
    bitmap = wanted.groupBy(word(wanted_key).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    near = rows.join(F.broadcast(bitmap), word(key) == F.col("_word"))
    return near.filter(F.getbit("_bits", place(key)) == 1).select(rows.columns)


def crc_of(column: Column) -> Column:
    return F.crc32(column.cast("string"))


def total(df: DataFrame, column: str) -> int:
    return int(df.agg(F.sum(column)).first()[0] or 0)


def packed(docs: DataFrame) -> DataFrame:
    """Whole rows as one column `__row`, so that no name of theirs can clash; `unpacked` gives them back."""
    return docs.select(F.struct("*").alias("__row"))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("__row.*")
