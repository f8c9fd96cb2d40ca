"""Registered queries over the driver's tables, their fixtures and their SQL counterparts."""

from catalog import text_queries  # noqa: F401
from catalog.registry import ORACLES, QUERIES  # noqa: F401
from catalog import report_queries, request_queries, scoring_queries, training_queries  # noqa: F401
