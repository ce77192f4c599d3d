"""Scans and sinks: driver tables, CSV files with explicit schemas, JSON messages."""

from tessera.sources.tables import TABLES, read_table, read_tables
from tessera.sources.files import (
    CATALOG_CSV_SCHEMA,
    EVAL_SCORE_SCHEMA,
    OFFER_CSV_SCHEMA,
    read_catalog_csv,
    read_offer_csv,
    read_scores_csv,
    write_scores_csv,
)

__all__ = [
    "TABLES", "read_table", "read_tables", "CATALOG_CSV_SCHEMA", "EVAL_SCORE_SCHEMA",
    "OFFER_CSV_SCHEMA", "read_catalog_csv", "read_offer_csv", "read_scores_csv",
    "write_scores_csv",
]
