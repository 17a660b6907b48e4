"""Queries over the driver's tables, each with the SQL it must agree with."""

from quarry.workload import (  # noqa: F401  (importing registers the queries)
    analytics_queries,
    consume_queries,
    operator_queries,
    quality_queries,
    source_queries,
    staging_queries,
)
from quarry.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
