"""Registered queries over the driver's tables."""

from tallygraph.plans import (file_queries, ledger_queries, profile_queries, stream_queries,  # noqa: F401
                              web_queries)
from tallygraph.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
