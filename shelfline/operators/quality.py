"""Data-quality operators. A check is a DataFrame of violations; `require_none` turns it into an error."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.columns import holds
from shelfline.operators.ordered import exact_quantiles
from shelfline.session import discard, materialize

# Words that mark a column as personal.
PERSONAL_WORDS = ("customer_id", "customer_fname", "customer_lname", "phone", "password", "email", "street", "zip")


class QualityError(ValueError):
    """A data-quality rule does not hold."""


def require_columns(present: Iterable[str], required: Iterable[str], label: str) -> None:
    missing = sorted(set(required) - set(present))
    if missing:
        raise QualityError(f"{label}: columns missing: {', '.join(missing)}")


def require_none(violations: DataFrame, message: str) -> None:
    """Stops at the first violation found."""
    if violations.limit(1).count():
        raise QualityError(message)


def unique_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null or occur more than once."""
    null_part = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter((F.col("rows") > 1) | null_part)


def unique_text_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key that is null or occurs more than once, for long texts: a key is shuffled as 128 bits of it."""
    halves = [F.xxhash64(F.lit(seed), *keys).alias(f"_{seed}") for seed in (0, 1)]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    nulls = [F.col(k).isNull() for k in keys]
    mask = F.when(known, F.lit(None)).otherwise(F.concat(*[n.cast("string") for n in nulls])).alias("_null")
    return df.select(*halves, mask).groupBy("_0", "_1", "_null").agg(F.count(F.lit(1)).alias("rows")).filter(
        (F.col("rows") > 1) | F.col("_null").isNotNull())


def stop_unless(condition: Column, message: str) -> Column:
    """A filter that every row passes; the first row for which the condition doesn't hold stops the query."""
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))


def one_row_each(df: DataFrame, keys: Sequence[str], label: str = "table") -> DataFrame:
    """`df` by its keys, as a plan that stops if one of them is null or has several rows. The check is the aggregate that the
    join on these keys would shuffle for in any case, so no path can skip it."""
    others = [c for c in df.columns if c not in keys]
    row = F.first(F.struct(*others)).alias("_row") if others else F.first(F.lit(True)).alias("_row")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    checked = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), row).filter(
        stop_unless(known & (F.col("_rows") == 1), f"{label}: null or repeated key {tuple(keys)}"))
    return checked.select(*keys, *[F.col("_row")[c].alias(c) for c in others])


def many_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], label: str, how: str = "inner") -> DataFrame:
    """A join that stops where the right side has a key twice; null keys meet no row."""
    return left.join(one_row_each(right, keys, label), list(keys), how)


def require_unique(df: DataFrame, keys: Sequence[str], label: str = "table") -> None:
    require_none(unique_key_violations(df, keys), f"{label}: null or repeated key {tuple(keys)}")


def key_rule_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(test, failures): per table the null or repeated values of its key, all tables in one job."""
    return rule_counts([(name, unique_key_violations(df, keys)) for name, (df, keys) in tables.items()])


def require_no_failures(counts: DataFrame, label: str) -> None:
    """Stops if a rule of (test, failures) rows, one row per rule, has a failure; names all that have."""
    failed = sorted(r["test"] for r in counts.filter("failures > 0").select("test").collect())
    if failed:
        raise QualityError(f"{label}: {', '.join(failed)}")


class Watch:
    """Row rules counted by the very job that writes a table, so that they need no scan of their own.

    `table` is the frame to write. After the job `counts` has the rows for which each condition holds. Where Spark computes a
    lost partition again it may count its rows again: a rule without a failing row still shows zero, and one with failing rows
    still shows some. Exact counts after a loss come from `counted_conditions`.
    """

    def __init__(self, df: DataFrame, conditions: Mapping[str, str]):
        self.observation = Observation()
        self.table = df.observe(self.observation, *[
            F.count(F.when(F.expr(condition), F.lit(1))).alias(name) for name, condition in conditions.items()])

    @property
    def counts(self) -> dict[str, int]:
        return self.observation.get

    def require_none(self, label: str) -> None:
        failed = sorted(name for name, n in self.counts.items() if n)
        if failed:
            raise QualityError(f"{label}: {', '.join(failed)}")

    def report(self, spark: SparkSession) -> DataFrame:
        """(test, failures), one row per rule."""
        return spark.createDataFrame(sorted(self.counts.items()), "test string, failures long")


def checked_table(df: DataFrame, name: str, conditions: Mapping[str, str], partition_by: tuple[str, ...] = ()) -> DataFrame:
    """`materialize` with row rules counted on the way; a table that breaks one is deleted again, and the run stops."""
    watch = Watch(df, conditions)
    table = materialize(watch.table, name, partition_by)
    try:
        watch.require_none(name)
    except QualityError:
        discard(table)
        raise
    return table


def rule_counts(rules: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(test, failures), one row per rule."""
    counted = [
        violations.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test"), "failures")
        for name, violations in rules
    ]
    return reduce(DataFrame.unionByName, counted)


def row_rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(test, failures) for conditions on single rows, all counted in one scan."""
    row = df.agg(*[F.count_if(holds(c)).alias(name) for name, c in rules.items()])
    return row.unpivot([], list(rules), "test", "failures")


def day_columns(df: DataFrame) -> list[str]:
    return df.select(df.colRegex("`^d_[0-9]+$`")).columns


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def panel_source_rules(wide: DataFrame, calendar: DataFrame, prices: DataFrame) -> list[tuple[str, DataFrame]]:
    """Rules for the three raw panel tables."""
    days = day_columns(wide)
    if not days:
        raise QualityError("no day columns")
    units = F.expr(f"array({', '.join(f'CAST({d} AS DOUBLE)' for d in days)})")
    any_bad = F.exists(units, lambda v: v.isNull() | (v < 0))
    return [
        ("duplicate_series", repeated(wide, ["item_id", "store_id"])),
        ("duplicate_day", repeated(calendar, ["d"])),
        ("duplicate_date", repeated(calendar, ["date"])),
        ("invalid_date", calendar.filter(F.expr("try_cast(date AS date)").isNull())),
        ("invalid_price", prices.filter(F.col("sell_price").isNull() | (F.col("sell_price") < 0))),
        ("invalid_demand", wide.filter(any_bad)),
        ("invalid_identity", wide.filter(
            F.col("item_id").isNull() | F.col("store_id").isNull() | ~F.col("state_id").isin("CA", "TX", "WI"))),
        ("duplicate_price", repeated(prices, ["item_id", "store_id", "wm_yr_wk"])),
    ]


def validate_panel_sources(wide: DataFrame, calendar: DataFrame, prices: DataFrame) -> None:
    require_columns(wide.columns, ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"], "sales")
    require_columns(
        calendar.columns,
        ["d", "date", "wm_yr_wk", "snap_CA", "snap_TX", "snap_WI", "event_name_1", "event_type_1",
         "event_name_2", "event_type_2"], "calendar")
    require_columns(prices.columns, ["item_id", "store_id", "wm_yr_wk", "sell_price"], "prices")
    require_no_failures(rule_counts(panel_source_rules(wide, calendar, prices)), "panel sources")


PANEL_ROWS = {
    "invalid_demand_or_date": "units_sold IS NULL OR units_sold < 0 OR date IS NULL",
    "sold_without_price": "units_sold > 0 AND sell_price IS NULL",
}
"""Rules on single rows of the long panel."""


def panel_rules(sales: DataFrame) -> list[tuple[str, DataFrame]]:
    """What violates the rules for the long panel, to look at."""
    return [
        *((name, sales.filter(F.expr(condition))) for name, condition in PANEL_ROWS.items()),
        ("repeated_day", repeated(sales, ["item_id", "store_id", "date"])),
        ("gap_in_history", contiguity(sales).filter(F.col("days") != F.col("expected_days"))),
    ]


def counted_conditions(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """(test, failures) of row rules, all in one scan: the rows for which each condition holds."""
    counts = df.agg(*[F.count_if(F.expr(condition)).alias(name) for name, condition in conditions.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("test"), F.col(n).alias("failures")) for n in conditions])))


def panel_key_counts(sales: DataFrame) -> DataFrame:
    """(test, failures) of the panel's rules on keys: repeated days and gaps in a history, in one grouped pass."""
    per_day = sales.groupBy("item_id", "store_id", "date").agg(F.count(F.lit(1)).alias("rows"))
    per_series = per_day.groupBy("item_id", "store_id").agg(
        F.count_if(F.col("rows") > 1).alias("repeated"),
        (F.sum("rows") != F.datediff(F.max("date"), F.min("date")) + 1).cast("long").alias("gap"))
    totals = per_series.agg(F.sum("repeated").alias("repeated_day"), F.sum("gap").alias("gap_in_history"))
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("test"), F.coalesce(n, F.lit(0).cast("long")).alias("failures")) for n in ("repeated_day", "gap_in_history")])))


def panel_rule_counts(sales: DataFrame) -> DataFrame:
    """(test, failures) of the long panel: row rules in one scan, key rules in one grouped pass."""
    return counted_conditions(sales, PANEL_ROWS).unionByName(panel_key_counts(sales))


def contiguity(sales: DataFrame) -> DataFrame:
    """Days held and days between first and last day, per series."""
    return sales.groupBy("item_id", "store_id").agg(
        F.count(F.lit(1)).alias("days"),
        (F.datediff(F.max("date"), F.min("date")) + 1).cast("long").alias("expected_days"),
    )


def validate_panel(sales: DataFrame) -> None:
    require_no_failures(panel_rule_counts(sales), "panel")


def shortest_history(sales: DataFrame) -> DataFrame:
    """One row: days of the shortest series."""
    return sales.groupBy("item_id", "store_id").agg(F.count(F.lit(1)).alias("days")).agg(
        F.min("days").alias("shortest_history")
    )


def require_history(sales: DataFrame, needed: int) -> None:
    shortest = shortest_history(sales).first()["shortest_history"]
    if shortest is None or shortest < needed:
        raise QualityError(f"every series needs {needed} days; the shortest has {shortest}")


def conflicting_groups(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Groups in which an attribute takes more than one value, null counting as a value.

    Rows are made distinct first, which combines before the shuffle and hashes; a group without a
    conflict is then a single row. Only groups with a conflict reach the comparison by attribute
    (minima of texts would sort all rows).
    """
    rows = df.select(key, *attributes).distinct()
    several = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
    differs = [
        holds(F.min(a) != F.max(a)) | ((F.count(a) > 0) & (F.count(a) < F.count(F.lit(1)))) for a in attributes
    ]
    return rows.join(several, key, "left_semi").groupBy(key).agg(*[d.alias(a) for d, a in zip(differs, attributes)])


def table_profile(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per column: type, missing, negative and zero counts, extrema, distinct values, dates,
    values outside 1.5 interquartile ranges, and the table's repeated rows.

    Columns with a personal name get counts only.
    """
    columns = list(names or df.columns)
    kinds = {f.name: f.dataType for f in df.schema if f.name in columns}
    personal = {c for c in columns if any(w in c.lower() for w in PERSONAL_WORDS)}
    numeric = [c for c, t in kinds.items() if isinstance(t, T.NumericType) and c not in personal]
    dates = [c for c, t in kinds.items() if "date" in c.lower() and not isinstance(t, T.NumericType)]

    number = {c: F.col(c).cast("double") for c in numeric}
    none = F.lit(None)

    # First scan. Each column's values, counted: pairs of column and value spread over all tasks, however skewed one value is,
    # and added up before the shuffle. All facts about values come from this one table.
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), number.get(c, none.cast("double")).alias("number"))
        for c in columns
    ])).alias("cell")).select("cell.*")
    counted = materialize(
        cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"), F.first("number").alias("number")), "profile")

    x, date, n = F.col("number"), F.expr("try_cast(value AS date)"), F.col("n")
    known = F.col("value").isNotNull()

    def rows_with(condition: Column) -> Column:
        return F.sum(F.when(holds(condition), n).otherwise(0))

    def of(names: Iterable[str], value: Column) -> Column:
        return F.when(F.col("column_name").isin(list(names)), value)

    texts = [c for c, t in kinds.items() if isinstance(t, T.StringType)]
    facts = counted.groupBy("column_name").agg(
        rows_with(~known).alias("missing"), rows_with(x < 0).alias("negative"), rows_with(x == 0).alias("zero"),
        F.min(x).alias("minimum"), F.max(x).alias("maximum"), rows_with(known & date.isNull()).alias("invalid_dates"),
        F.min(date).alias("date_min"), F.max(date).alias("date_max"),
        rows_with(F.col("value").contains("�")).alias("replacement_characters"), F.count_if(known).alias("unique_values"))
    described = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c].simpleString()).alias("data_type")) for c in columns])))

    def counts_of(name: str) -> Column:
        return F.coalesce(name, F.lit(0).cast("long"))

    profile = described.join(facts, "column_name", "left").select(
        "column_name", "data_type", counts_of("missing").alias("missing"),
        *[of(numeric, counts_of(c)).alias(c) for c in ("negative", "zero")],
        *[of(numeric, F.col(c)).alias(c) for c in ("minimum", "maximum")],
        of(dates, counts_of("invalid_dates")).alias("invalid_dates"),
        *[of(dates, F.col(c)).alias(c) for c in ("date_min", "date_max")],
        F.when(F.col("column_name").isin(texts), counts_of("replacement_characters")).otherwise(0).alias("replacement_characters"),
        counts_of("unique_values").alias("unique_values"))
    if numeric:
        numbers = counted.filter("number IS NOT NULL")
        q = exact_quantiles(numbers, ["column_name"], "number", {"q1": 0.25, "q3": 0.75}, count="n")
        spread = 1.5 * (F.col("q3") - F.col("q1"))
        outside = (F.col("number") < F.col("q1") - spread) | (F.col("number") > F.col("q3") + spread)
        outliers = numbers.join(F.broadcast(q), "column_name").groupBy("column_name").agg(  # one row per column
            F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outliers_iqr"))
        profile = profile.join(outliers, "column_name", "left")
        # A numeric column without a value has no outliers.
        profile = profile.withColumn("outliers_iqr", F.when(
            F.col("column_name").isin(numeric), F.coalesce("outliers_iqr", F.lit(0).cast("long"))))
    else:
        profile = profile.withColumn("outliers_iqr", none.cast("long"))
    duplicates = repeated_rows(df, columns)
    rows = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    return profile.select(rows.alias("rows"), duplicates.scalar().alias("duplicate_rows"), *profile.columns)


def repeated_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, `duplicate_rows`: the rows beyond the first of each group of equal ones, null equal to null.

    Only 128 bits of a row are shuffled. Rows that share them with another are few or truly repeated; they are compared whole
    among themselves, counted before the shuffle.
    """
    halves = [F.xxhash64(F.lit(seed), *[part for c in columns for part in (F.col(c).isNull(), F.col(c))]) for seed in (0, 1)]
    shared = df.select(halves[0].alias("_a"), halves[1].alias("_b")).groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n"))
    shared = materialize(shared.filter("_n > 1").select("_a", "_b"), "shared_digests")
    whole = df.select(*columns, halves[0].alias("_a"), halves[1].alias("_b")).join(shared, ["_a", "_b"], "left_semi")
    return whole.groupBy("_a", "_b", *columns).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0).cast("long")).alias("duplicate_rows"))


def personal_columns(tables: Mapping[str, Sequence[str]]) -> list[tuple[str, str]]:
    """(table, column) for column names that speak of a person."""
    return [(t, c) for t, names in tables.items() for c in names if any(w in c.lower() for w in PERSONAL_WORDS)]
