"""Every operator as a query over the test tables, with an equivalent SQL text."""

from rimeframe.catalog import (  # noqa: F401  (importing registers the queries)
    analysis_queries,
    evaluation_queries,
    gold_queries,
    inventory_queries,
    model_queries,
    neighbour_queries,
    silver_queries,
    source_queries,
)
from rimeframe.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
