"""Query catalog: the registry with all modules of queries loaded."""

from __future__ import annotations

# ruff: noqa: F401 -- modules register their queries on import
from losslens.plans import (
    q_erosion, q_aggregates, q_concentration, q_quality, q_features, q_stats, q_segment, q_model, q_ols, q_external, q_jobs)
from losslens.plans.registry import QUERIES, featured_items, oracle, register, returned_items, spark_query
