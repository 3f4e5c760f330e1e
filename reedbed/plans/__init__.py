"""Named queries over the given tables, each with its check in SQL where one exists."""

from reedbed.plans import array_queries, model_queries, recording_queries, report_queries, sampling_queries  # noqa: F401
from reedbed.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
