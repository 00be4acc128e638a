"""Registry of the queries over the driver's tables and of their SQL oracles."""

from __future__ import annotations

from tallgrass.plans import archive_queries, search_queries, transcript_queries, vector_queries  # noqa: F401
from tallgrass.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
