"""Readers and writers."""

from assayloom.sources.readers import read_csv, read_parquet, read_table, rows_to_table
from assayloom.sources.wide_csv import read_wide_csv, write_wide_csv
from assayloom.sources.writers import write_csv, write_parquet

__all__ = ["read_csv", "read_parquet", "read_table", "read_wide_csv", "rows_to_table", "write_csv", "write_parquet", "write_wide_csv"]
