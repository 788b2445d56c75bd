"""The whole analysis, from sources to exports."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators import (
    constraints, dimensions, forecast, learned, orders, panel, policy, quality, replay, risk, segments,
)
from shelfline.operators.features import add_features
from shelfline.plans import kpis, marts
from shelfline.session import materialize, tune
from shelfline.settings import DEFAULTS, Settings
from shelfline.sources import publish, refresh, sinks


def compare_models(
    sales: DataFrame, calendar: DataFrame, folds: list[forecast.Fold], settings: Settings, with_learned: bool,
) -> DataFrame:
    """Backtest rows of the baselines and, if wanted, of the learned model trained anew per fold."""
    rows = forecast.backtest(sales, folds, settings.fold_days)
    if not with_learned:
        return rows
    rows = materialize(rows, "baselines")
    return rows.unionByName(learned.backtest_rows(rows, sales, calendar, folds, settings.fold_days, settings))


def next_forecast(
    sales: DataFrame, calendar: DataFrame, end, chosen: DataFrame, errors: DataFrame, settings: Settings,
) -> DataFrame:
    """The champion's forecast after the last day, whichever kind of model it is."""
    forecast.require_calendar(calendar, end, settings.forecast_horizon)
    if chosen.first()["model"] == learned.NAME:
        predicted = learned.learned_forecast(sales, calendar, end, settings.forecast_horizon, settings)
        return forecast.add_intervals(predicted, errors)
    return forecast.production_forecast(sales, end, chosen, errors, settings.forecast_horizon)


def gate(staged: dict[str, DataFrame], report: str) -> DataFrame:
    """Failures of the integrity tests and of all constraints on the staged tables, also written to `report`."""
    tables = {name.split(".")[1]: df for name, df in staged.items()}
    named = tables | {
        "sales": tables["fact_sales_daily"], "forecast": tables["fact_forecast"], "policy": tables["fact_inventory_policy"],
        "ledger": tables["fact_inventory_replay"], "lines": tables["fact_orders"], "delivery": tables["fact_delivery_performance"],
        "sell_price": tables["fact_sell_price"],
    }
    named["shipping_mode"] = marts.shipping_mode_performance(named["delivery"])
    tests = constraints.integrity_tests(named, {name: df.columns for name, df in named.items()}).unionByName(
        constraints.constraint_counts(named))
    tests = materialize(tests, "gate")
    sinks.write_json(tests, report)
    return tests


# Facts are exported as Parquet only.
FACTS = ("fact_lines", "fact_delivery", "fact_sell_price", "backtest", "test", "ledger", "order_profit")


def run(
    wide: DataFrame, calendar: DataFrame, prices: DataFrame, raw_lines: DataFrame, out: str,
    settings: Settings = DEFAULTS, mode: str = "full", provenance: str = "source", with_learned: bool = True,
    with_risk: bool = False, supplied_assumptions: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Validate, transform, forecast, plan and export. Returns the exported tables by name.

    `out` is replaced table by table. Rules that fail stop the run before anything depends on them.
    """
    spark = tune(wide.sparkSession)
    quality.validate_panel_sources(wide, calendar, prices)
    panel_rows = panel.build_sales(panel.unpivot_days(wide), calendar, prices)
    if mode == "sample":
        everything = materialize(panel_rows, "panel")
        panel_rows = panel.keep_cohort(everything, panel.sample_cohort(everything, settings))
    watch = quality.Watch(panel_rows, quality.PANEL_ROWS)
    sinks.write_partitioned(watch.table, f"{out}/sales_daily")
    watch.require_none("panel")
    sales = spark.read.schema(panel_rows.schema).parquet(f"{out}/sales_daily")
    quality.require_no_failures(quality.panel_key_counts(sales), "panel")
    quality.require_history(sales, settings.fold_days * settings.backtest_folds + settings.minimum_history_days)
    features = add_features(sales)
    sinks.export_large(features, "forecast_features", out)
    features = spark.read.schema(features.schema).parquet(f"{out}/forecast_features.parquet")

    lines, delivery = orders.transform_orders(raw_lines, settings)
    lines, delivery = materialize(lines, "lines"), materialize(delivery, "delivery")
    end = sales.agg(F.max("date")).first()[0]
    today = F.lit(end)
    order_profit = orders.order_profit(lines)
    dims = dimensions.all_dimensions(sales, calendar, lines)
    current = materialize(panel.history_summary(sales, today, settings), "history")
    performance = materialize(segments.segmentation(current, settings), "segments")

    folds = forecast.rolling_folds(end, settings)
    backtest = materialize(compare_models(sales, calendar, folds, settings, with_learned), "backtest")
    metrics = forecast.model_metrics(backtest).unionByName(forecast.portfolio_metrics(backtest))
    chosen = materialize(forecast.champion(metrics), "champion")
    test = materialize(forecast.selected_test(backtest, chosen, settings), "test")
    errors = forecast.pretest_errors(backtest, chosen, settings)
    future = materialize(next_forecast(sales, calendar, end, chosen, errors, settings), "future")

    def assumed(history: DataFrame) -> DataFrame:
        return policy.create_assumptions(history, settings)

    assumptions = assumed(current)
    if supplied_assumptions is not None:
        assumptions = policy.override(assumptions, supplied_assumptions)
    policy.require_inputs(assumptions, settings.service_levels)
    plan = materialize(policy.compute_policies(
        current, future, assumptions, errors, settings.service_levels, end), "policy")
    # The replay repeats the planning at the test origin; nothing later enters it.
    origin = folds[-1].origin
    before = materialize(panel.history_summary(sales, F.lit(origin), settings), "pretest_history")
    draws = replay.hashed_lead_draws(test, settings.replay_runs, settings.fold_days)
    replays = {}
    for name, cases in (("base", policy.BASE_CASE), ("grid", policy.sensitivity_cases())):
        planned = policy.compute_policies(before, test, assumed(before), errors, settings.service_levels, origin, cases)
        replays[name] = replay.replay(test, planned, draws, settings)
    ledger = materialize(replays["base"], "ledger")
    ledger_kpis = materialize(replay.ledger_kpis(ledger), "ledger_kpis")

    level = settings.default_service_level
    accuracy = forecast.segment_metrics(test, segments.segmentation(before, settings))
    shipping, profits = orders.delivery_summary(delivery), orders.profit_summary(lines)
    profiles = panel.dimension_profiles(sales)
    tables = {
        **dims, "fact_lines": lines, "fact_delivery": delivery, "delivery_summary": shipping,
        "category_delivery": orders.category_delivery(lines, delivery), "profit_summary": profits,
        "order_profit": order_profit, "monthly_orders": orders.monthly_orders(lines),
        "period_rollups": panel.period_rollups(sales), "dimension_profiles": profiles,
        "price_demand_correlation": panel.price_demand_correlation(features), "product_store_performance": performance,
        "backtest": backtest, "test": test, "model_metrics": metrics, "segment_metrics": accuracy, "forecast": future,
        "assumptions": assumptions, "policy": plan, "excess_inventory": plan.filter("excess_units > 0"),
        "stockout_risk": marts.stockout_risk(plan), "ledger": ledger, "ledger_kpis": ledger_kpis,
        "sensitivity": replay.ledger_kpis(replays["grid"]),
        "executive_kpis": kpis.executive_table(sales, future, ledger_kpis, delivery, order_profit, level, provenance),
        "recommendations": kpis.recommendations(
            plan, accuracy, performance, profiles.filter("dimension = 'event_name'"), shipping, profits, ledger_kpis, level, provenance),
        "refresh_metadata": sinks.run_metadata(spark, provenance, mode),
    }
    if with_risk:
        scores, weights = risk.fit_risk_models(delivery, settings)
        tables.update(delivery_risk_metrics=risk.risk_metrics(scores), delivery_risk_weights=weights)
    for name, df in tables.items():
        (sinks.export_large if name in FACTS else sinks.export)(df, name, out)
    exported = {name: spark.read.schema(df.schema).parquet(f"{out}/{name}.parquet") for name, df in tables.items()}

    refresh.refresh_monthly(spark, f"{out}/sales_daily", f"{out}/monthly_sales")
    publish.publish({**exported, "sales": sales}, f"{out}/serving", lambda staged: gate(staged, f"{out}/integrity_tests.json"))
    manifest = spark.createDataFrame([(mode, provenance, chosen.first()["model"], str(dataclasses.asdict(settings)))],
                                     "mode string, provenance string, selected_model string, settings string")
    sinks.write_json(manifest, f"{out}/manifest.json")
    return {**exported, "sales": sales}
