"""All named queries."""

from trellis.plans import (  # noqa: F401
    catalog_graph,
    catalog_joins,
    catalog_ml,
    catalog_select,
    catalog_tables,
    catalog_usecases,
)
from trellis.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
