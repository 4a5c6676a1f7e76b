"""All queries of this package's own operators, and their SQL counterparts."""

from __future__ import annotations

from quirework.plans import common, export_queries, layout_queries, raster_queries, sequence_queries, zone_queries  # noqa: F401  importing them registers the queries


def queries() -> dict:
    return dict(common.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(common.SQL)
