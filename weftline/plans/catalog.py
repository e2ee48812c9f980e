"""All registered queries."""

from weftline.plans import (  # noqa: F401
    change_queries,
    document_queries,
    keyvalue_queries,
    relational_queries,
    streaming_queries,
    subquery_queries,
    window_queries,
)
from weftline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
