"""The whole analysis on the small tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.plans.run import compare_models, run
from shelfline.settings import Settings
from shelfline.sources import publish, refresh, schemas
from shelfline.sources.readers import admit_order_columns


def test_run(data, tmp_path):
    settings = Settings(boosting_rounds=2, sample_series=6)
    supplied = data.sales.select("item_id", "store_id").distinct().limit(1).withColumn("average_lead_time_days", F.lit(4.0))
    lines, _ = admit_order_columns(data.raw_lines)
    tables = run(data.wide, data.calendar, data.prices, lines, str(tmp_path), settings, mode="sample",
                 supplied_assumptions=supplied, with_learned=False)
    assert tables["sales"].select("item_id", "store_id").distinct().count() == 6
    assert tables["forecast"].count() == 6 * 28
    assert {r["model"] for r in tables["backtest"].select("model").distinct().collect()} == {
        "naive", "seasonal_7", "seasonal_28", "moving_average"}
    assert tables["policy"].count() == 6 * 3
    assert tables["ledger"].count() == 6 * 3 * 3 * 2 * 28
    assert tables["sensitivity"].count() == 13 * 6 * 3 * 3 * 2
    assert tables["executive_kpis"].count() == 6
    served = publish.read(data.spark, f"{tmp_path}/serving", "panel.fact_sales_daily")
    assert served.count() == tables["sales"].count()
    assert len(list((tmp_path / "serving" / "runs").iterdir())) == 1
    assert set(p.name for p in next((tmp_path / "serving" / "runs").iterdir()).iterdir()) == set(schemas.SERVING) and len(schemas.SERVING) == 23
    monthly = refresh.read_monthly(data.spark, f"{tmp_path}/monthly_sales")
    assert monthly.agg(F.sum("units_sold")).first() == tables["sales"].agg(F.sum("units_sold")).first()
    assert (tmp_path / "forecast.csv").is_dir() and (tmp_path / "manifest.json").is_dir()
    for name, df in tables.items():
        assert not [c for c in df.columns if "email" in c or "fname" in c], name


def test_learned_model_is_a_candidate(data):
    folds = data.folds[-1:]
    rows = compare_models(data.sales, data.calendar, folds, Settings(boosting_rounds=2), with_learned=True)
    counts = {r["model"]: r["count"] for r in rows.groupBy("model").count().collect()}
    assert len(counts) == 5 and len(set(counts.values())) == 1
    assert rows.filter("model = 'global_model' AND (error IS NULL OR scale IS NULL AND fold <> 3)").count() == 0
