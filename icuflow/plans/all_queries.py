"""Imports every query module, so the registry is complete."""

from icuflow.plans import q_clinic, q_cohort, q_models, q_series, q_stats, q_tables, q_trees  # noqa: F401
from icuflow.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
