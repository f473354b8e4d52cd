"""Readers for landed API pages, stored tables and the CRM's own catalogues."""

from martloom.sources.catalogs import (
    entity_type_ids, field_catalogue, list_catalogue, positive_ids, rows_for_owners,
)
from martloom.sources.pages import (
    TYPED_ROWS, check_pages, dedupe_pages, field_names, landing_order, matrix_columns, page_totals, read_envelope, read_matrix, spread_map,
    survey_pages, unwrap_first, unwrap_key,
)
from martloom.sources.tables import (
    column_names, has_column, has_table, keyset_scan, load_jdbc, load_sources, load_table, read_stored, table_path,
)
from martloom.sources.versions import expire, history, read_part, read_version, version

__all__ = [
    "TYPED_ROWS", "check_pages", "column_names", "dedupe_pages", "entity_type_ids", "expire", "field_catalogue",
    "field_names", "has_column", "has_table", "history", "keyset_scan", "landing_order", "list_catalogue",
    "load_jdbc", "load_sources", "load_table", "matrix_columns", "page_totals", "positive_ids", "read_envelope",
    "read_matrix", "read_part", "read_stored", "read_version", "rows_for_owners", "spread_map", "survey_pages",
    "table_path", "unwrap_first", "unwrap_key", "version",
]
