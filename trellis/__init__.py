"""Property-graph tables, pattern joins, graph analytics and table operators on PySpark."""

from trellis.model import PropertyGraph

__all__ = ["PropertyGraph"]
