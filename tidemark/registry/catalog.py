"""All named queries."""

from tidemark.registry import business, landing, layers, quality, relational, scalars  # noqa: F401  (importing registers)
from tidemark.registry.core import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
