"""Operators over one global order, without pulling the order through a single task.

`Window.orderBy` without a partition moves every row to one task. Here rows are range-partitioned
on the full order key, each range is totalled, and the totals of the ranges before it (one row per
range, so a table no larger than the partition count) are added to a running window inside the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.session import materialize

BUCKET = "_bucket"


def _ranges(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    """Add the number of the order range a row lies in. The result is written once: range bounds
    come from a sample, so a recomputed plan could cut the order elsewhere."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).withColumn(BUCKET, F.spark_partition_id())
    return materialize(placed, "ordered")


def running_totals(
    df: DataFrame, order: Sequence[Column], values: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Add `prior_<v>` (total of the rows before this one) and `total_<v>` for each value column.

    `order` has to be a unique key of the rows.
    """
    placed = _ranges(df, order, partitions)
    per_range = placed.groupBy(BUCKET).agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_range.select(
        BUCKET,
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_before_{v}") for v in values],
        *[F.sum(v).over(whole).alias(f"total_{v}") for v in values],
    )
    inside = Window.partitionBy(BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(F.broadcast(offsets), BUCKET).select(
        *df.columns,
        *[(F.col(f"_before_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"prior_{v}") for v in values],
        *[f"total_{v}" for v in values],
    )


def running_totals_within(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], values: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Add `prior_<v>` (total of the group's rows before this one) and `total_<v>` (of the whole group), where a group may be
    larger than a task: (groups, order) is cut into ranges, and the totals of a group's earlier ranges are added to a window
    inside each. `groups` and `order` together have to be a unique key; group columns must not be null."""
    placed = _ranges(df, [*[F.col(g).asc() for g in groups], *order], partitions)
    per_range = placed.groupBy(*groups, BUCKET).agg(*[F.sum(v).alias(v) for v in values])
    # One row per range that holds a part of the group.
    earlier = Window.partitionBy(*groups).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_range.select(
        *groups, BUCKET,
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_before_{v}") for v in values],
        *[F.sum(v).over(whole).alias(f"total_{v}") for v in values])
    inside = Window.partitionBy(*groups, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(offsets, [*groups, BUCKET]).select(
        *df.columns,
        *[(F.col(f"_before_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"prior_{v}") for v in values],
        *[f"total_{v}" for v in values])


def value_positions(df: DataFrame, value: str, descending: bool = False) -> DataFrame:
    """One row per distinct value: `tied` rows hold it, `prior_tied` rows come before it, and
    `dense_position` distinct values up to and including it. Ties are counted before the shuffle,
    so a value that most rows share costs no more than a rare one."""
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("tied")).withColumn("one", F.lit(1).cast("long"))
    order = F.col(value).desc() if descending else F.col(value).asc()
    return running_totals(counted, [order], ["tied", "one"]).select(
        value, "tied", "prior_tied", "total_tied", (F.col("prior_one") + 1).alias("dense_position")
    )


def dense_ranked(df: DataFrame, value: str, name: str, descending: bool = True) -> DataFrame:
    """Add the dense rank of `value` over all rows."""
    positions = value_positions(df, value, descending).select(
        F.col(value).alias("_value"), F.col("dense_position").alias(name)
    )
    return df.join(positions, F.col(value).eqNullSafe(F.col("_value")), "left").drop("_value")


def average_percent_ranked(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add the percent rank in which tied rows share the mean of their ranks."""
    positions = value_positions(df, value).select(
        F.col(value).alias("_value"),
        ((F.col("prior_tied") + (F.col("tied") + 1) / 2.0) / F.col("total_tied")).alias(name),
    )
    return df.join(positions, F.col(value).eqNullSafe(F.col("_value")), "left").drop("_value")


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, probabilities: dict[str, float], count: str | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles per group, one column per entry of `probabilities`.

    The built-in `percentile` keeps every distinct value of a group in one buffer. Here equal values
    are counted first and the counts are accumulated along (groups, value) in ranges, so a group may
    be larger than a task. Group columns must not be null. `count` names a column that says how
    often a row's value occurs, if the values come counted.
    """
    groups = list(groups)
    times = F.sum(count) if count else F.count(F.lit(1))
    counted = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(times.alias("_n"))
    placed = _ranges(counted, [F.col(c).asc() for c in [*groups, value]], None)
    per_range = placed.groupBy(*groups, BUCKET).agg(F.sum("_n").alias("_in_range"))
    # At most one row per range and group enters these windows.
    earlier = Window.partitionBy(*groups).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    whole = (
        Window.partitionBy(*groups).orderBy(BUCKET)
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    offsets = per_range.select(
        *groups, BUCKET,
        F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_in_range").over(whole).alias("_rows"),
    )
    inside = Window.partitionBy(*groups, BUCKET).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    located = placed.join(offsets, [*groups, BUCKET]).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(inside)
    )
    picks, results = [], []
    for name, p in probabilities.items():
        at = F.lit(float(p)) * (F.col("_rows") - 1)
        for side, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            covers = (F.col("_upto") - F.col("_n") <= place) & (place < F.col("_upto"))
            picks.append(F.max(F.when(covers, F.col(value).cast("double"))).alias(f"_{name}_{side}"))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        results.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return located.groupBy(*groups).agg(F.max("_rows").alias("_rows"), *picks).select(*groups, *results)
