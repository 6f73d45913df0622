"""Registered queries (Spark builders + DuckDB oracle SQL)."""

from . import (clean_queries, eval_queries, ingest_queries, mart_queries,  # noqa: F401
               model_queries, series_queries)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
