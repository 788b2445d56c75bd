"""Run parameters. One frozen object is passed to every operator that needs a threshold."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    seed: int = 42

    # Cohort choice and training sample.
    sample_stores: int = 2
    sample_series: int = 24
    selection_days: int = 90
    training_days: int = 365
    minimum_history_days: int = 180

    # Learners.
    boosting_rounds: int = 40
    count_rounds: int = 20
    forest_trees: int = 100
    classifier_rounds: int = 100

    # Backtest.
    forecast_horizon: int = 28
    backtest_folds: int = 3

    # Segmentation.
    summary_days: int = 90
    abc_shares: tuple[float, float] = (0.8, 0.95)
    xyz_cv: tuple[float, float] = (0.5, 1.0)
    intermittent_zero_share: float = 0.5

    # Inventory assumptions.
    simulation_days: int = 28
    replay_runs: int = 3
    service_levels: tuple[float, ...] = (0.90, 0.95, 0.98)
    default_service_level: float = 0.95
    lead_time_days: tuple[int, int] = (3, 10)
    lead_time_std_days: float = 1.5
    lead_time_prior: int = 5
    ordering_cost: float = 25.0
    holding_rate: float = 0.25
    cost_to_price: float = 0.65
    penalty_to_price: float = 0.4
    initial_days_supply: int = 14
    review_period_days: int = 7
    minimum_order_quantity: int = 6
    case_pack_size: int = 6
    baseline_days_cover: int = 14

    # Order lines.
    profit_source: str = "benefit_per_order"
    net_sales_source: str = "order_item_total"
    maximum_shipping_days: int = 90

    @property
    def fold_days(self) -> int:
        """Length of one validation window; never shorter than four weeks."""
        return max(28, self.simulation_days)


DEFAULTS = Settings()
