"""Importing the catalog registers every query."""

from . import analytics_queries, ledger_queries, ml_queries, monitoring_queries, panel_queries  # noqa: F401
from . import extra_queries, model_queries, stream_queries  # noqa: F401,E402  (need the modules above)
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
