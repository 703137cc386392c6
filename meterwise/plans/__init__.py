"""Registered queries."""

from meterwise.plans import (  # noqa: F401
    aggregates,
    cleaning,
    clustering,
    enrichment,
    evaluation,
    learning,
    preparation,
    recommendation,
    scalars,
    series,
    sources,
    testing,
)
from meterwise.plans.registry import ORACLE, QUERIES, TABLES

__all__ = ["ORACLE", "QUERIES", "TABLES"]
