"""Readers, writers and catalogue adapters."""

from .tables import read_table, read_csv_catalog, write_catalog, read_catalog
from .adapters import raw_films, raw_credits, raw_series, items, films, series

__all__ = ["read_table", "read_csv_catalog", "write_catalog", "read_catalog",
           "raw_films", "raw_credits", "raw_series", "items", "films", "series"]
