"""Operators for training-data pipelines and their registered queries."""

from meterwise.llm import queries as _queries

QUERIES = _queries.QUERIES
ORACLE = _queries.ORACLE

__all__ = ["ORACLE", "QUERIES"]
