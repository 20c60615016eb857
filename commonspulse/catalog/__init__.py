"""All registered queries."""

from commonspulse.catalog import (  # noqa: F401
    function_queries,
    history_queries,
    io_queries,
    load_queries,
    panel_queries,
    view_queries,
    warehouse_queries,
)
from commonspulse.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
