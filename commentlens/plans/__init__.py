"""Queries over the test tables."""

from commentlens.plans import (  # noqa: F401
    model_queries,
    stream_queries,
    table_queries,
    text_queries,
)
from commentlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
