"""Every operator as a query over the given tables, each with the SQL that states its result."""

from quayside.catalog import (  # noqa: F401
    audit_queries,
    file_queries,
    function_queries,
    quality_queries,
    run_queries,
    table_queries,
)
from quayside.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
