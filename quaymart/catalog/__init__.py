"""Ready-made queries over a folder of Parquet tables, with equivalent SQL.

Each query runs an operator or a job over whole tables.  The SQL states the same
result for another engine to check.
"""

from quaymart.catalog import (
    filters,
    jobs,
    labels,
    lookups,
    profiles,
    quality,
    rollups,
    scalars,
    storage,
)
from quaymart.catalog.registry import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "filters",
    "jobs",
    "labels",
    "lookups",
    "profiles",
    "quality",
    "rollups",
    "scalars",
    "storage",
]
