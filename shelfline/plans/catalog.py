"""Every registered query, by name."""

from __future__ import annotations

from shelfline.plans import forecast_queries, inventory_queries, kpi_queries, learned_queries, order_queries, panel_queries
from shelfline.plans.query import Query

CATALOG: dict[str, Query] = {q.name: q for module in (panel_queries, order_queries, forecast_queries, inventory_queries, kpi_queries, learned_queries) for q in module.QUERIES}
