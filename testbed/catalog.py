"""All registered queries."""

from testbed import (  # noqa: F401
    conform_queries, function_queries, pipeline_queries, rollup_queries, storage_queries,
)
from testbed.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
