"""Publishing in two steps, and the monthly table that follows its source."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfline.operators.quality import QualityError
from shelfline.plans.marts import sales_performance
from shelfline.sources import publish, refresh, schemas, sinks

TARGETS = {"common.a": schemas.table("k int, v string"), "panel.b": schemas.table("k int, w double")}
SERVED = {"common.a": "a", "panel.b": "b"}


def frames(spark, n):
    return {"a": spark.createDataFrame([(i, f"run {n}", "left out") for i in range(n)], "k int, v string, private string"),
            "b": spark.createDataFrame([(i,) for i in range(n)], "k int")}


def negative(staged):
    return staged["panel.b"].agg(F.count_if(F.col("k") < 0).alias("failures")).withColumn("test", F.lit("negative"))


def published(spark, root):
    return [publish.read(spark, root, t, TARGETS).count() for t in TARGETS]


def put(spark, root, n, gate=negative, run_id=None):
    return publish.publish(frames(spark, n), root, gate, run_id, TARGETS, SERVED)


def test_readers_see_whole_runs(spark, tmp_path):
    root = str(tmp_path / "serving")
    with pytest.raises(QualityError, match="nothing is published"):
        publish.read(spark, root, "common.a", TARGETS)
    first = put(spark, root, 2)
    assert published(spark, root) == [2, 2] and publish.current(spark, root) == first
    assert publish.read(spark, root, "common.a", TARGETS).columns == ["k", "v"]
    assert publish.read(spark, root, "panel.b", TARGETS).filter("w IS NOT NULL").isEmpty()
    old = publish.read(spark, root, "common.a", TARGETS)
    second = put(spark, root, 3)
    assert published(spark, root) == [3, 3] and old.count() == 2  # a reader that began before goes on
    assert publish.retire(spark, root, keep=1) == [first]
    assert publish.current(spark, root) == second and published(spark, root) == [3, 3]


def test_a_failing_gate_leaves_the_old_run(spark, tmp_path):
    root = str(tmp_path / "serving")
    put(spark, root, 2)
    with pytest.raises(QualityError, match="the gate of run"):
        put(spark, root, 4, lambda staged: negative(staged).withColumn("failures", F.lit(1)))
    assert published(spark, root) == [2, 2]


@pytest.mark.parametrize("step", ["stage", "gate", "switch"])
def test_a_run_that_ends_between_the_steps(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "serving")
    put(spark, root, 2)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if step == "stage":
            patch.setattr(publish, "conform", lambda df, schema: df.limit(0) if "w" not in schema.names else killed())
        if step == "switch":
            patch.setattr(publish, "files_of", lambda spark, path, f=publish.files_of: killed() if path.endswith("2") else f(spark, path))
        with pytest.raises(KeyboardInterrupt):
            put(spark, root, 5, killed if step == "gate" else negative)
    assert published(spark, root) == [2, 2]
    put(spark, root, 6)
    assert published(spark, root) == [6, 6]


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "serving")
    put(spark, root, 2)
    before = publish._pointers(spark, root)
    put(spark, root, 3)
    with monkeypatch.context() as patch:
        patch.setattr(publish, "_pointers", lambda *_: before)  # what the slower writer had listed
        with pytest.raises(QualityError, match="another run"):
            put(spark, root, 4)
    assert published(spark, root) == [3, 3]


def test_the_monthly_table_follows_its_source(spark, data, tmp_path):
    source, target = str(tmp_path / "sales"), str(tmp_path / "monthly")
    sinks.write_partitioned(data.sales, source)
    whole = {(r["store_id"], r["year"]) for r in data.sales.select("store_id", "year").distinct().collect()}
    expected = lambda sales: sales_performance(sales, data.products, data.stores)

    def same(sales):
        got = refresh.read_monthly(spark, target).select("month", "category_id", "state_id", "store_id", "units_sold", F.round("revenue", 4))
        want = expected(sales).select("month", "category_id", "state_id", "store_id", "units_sold", F.round("revenue", 4))
        return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

    assert set(refresh.refresh_monthly(spark, source, target)) == whole and same(data.sales)
    assert refresh.refresh_monthly(spark, source, target) == []
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "monthly").rglob("*.parquet")}
    store, year = sorted(whole)[1]
    touched = data.sales.withColumn("units_sold", F.when((F.col("store_id") == store) & (F.col("year") == year), F.col("units_sold") + 1)
                                    .otherwise(F.col("units_sold")))
    touched.filter((F.col("store_id") == store) & (F.col("year") == year)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("store_id", "year").parquet(source)
    assert refresh.refresh_monthly(spark, source, target) == [(store, year)] and same(touched)
    kept = {p for p, t in files.items() if p.exists() and p.stat().st_mtime_ns == t and "_log" not in str(p)}
    assert {p for p in files if "_log" not in str(p)} - kept == {p for p in files if f"store_id={store}/year={year}/" in str(p)}


def test_a_partition_that_is_gone(spark, tmp_path):
    source, target = str(tmp_path / "sales"), str(tmp_path / "monthly")
    rows = spark.range(4).selectExpr("cast(id as string) AS item_id", "'C' AS category_id", "'CA' AS state_id", "date'2020-01-05' AS date", "id AS units_sold",
                                     "1.0D AS revenue", "concat('S/', id % 2) AS store_id", "2020 AS year")
    rows.write.partitionBy("store_id", "year").parquet(source)
    assert refresh.refresh_monthly(spark, source, target) == [("S/0", 2020), ("S/1", 2020)]
    rows.filter("store_id = 'S/0'").write.mode("overwrite").partitionBy("store_id", "year").parquet(source)
    assert refresh.refresh_monthly(spark, source, target) == [("S/0", 2020)]
    assert [(r["store_id"], r["units_sold"]) for r in refresh.read_monthly(spark, target).collect()] == [("S/0", 2)]


def test_a_frame_of_two_targets_is_computed_once(spark, tmp_path):
    schema = publish.schemas.table("k long, v double")
    rows = spark.range(50).select(F.col("id").alias("k"), F.rand().alias("v"))
    targets, served = {"a.one": schema, "a.two": schema}, {"a.one": "rows", "a.two": "rows"}
    staged = publish.stage({"rows": rows}, str(tmp_path), "r", targets, served)
    assert sorted(staged["a.one"].collect()) == sorted(staged["a.two"].collect())
