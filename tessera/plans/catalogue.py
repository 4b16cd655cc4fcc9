"""All queries of the library and their SQL; the other modules add theirs to the same tables."""

from tessera.plans import grid_queries, register_queries  # noqa: F401
from tessera.plans.queries import ORACLE_SQL, QUERIES, flagship

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
