"""All queries of the survey operators and their oracle SQL."""

from __future__ import annotations

from . import catalog_queries, check_queries, file_queries, header_queries, line_queries, pixel_queries, point_queries, preview_queries, raster_queries, source_queries, sql_queries, text_queries

MODULES = (line_queries, file_queries, point_queries, raster_queries, catalog_queries, header_queries, check_queries, source_queries, sql_queries, pixel_queries, preview_queries, text_queries)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: q for m in MODULES for k, q in m.ORACLE.items()}
