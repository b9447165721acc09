"""All registered queries."""

from cotalake.catalog import checks, clients, funds, landing, silver, streams  # noqa: F401
from cotalake.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
