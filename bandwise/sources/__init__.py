"""Scans and sinks: parquet/CSV tables, report writes, fitted artefacts."""

from bandwise.sources.tables import load_table, TABLES
from bandwise.sources.files import read_csv, write_report, save_table, load_saved_table
from bandwise.sources.synthetic import random_table

__all__ = ["load_table", "TABLES", "read_csv", "write_report", "save_table", "load_saved_table", "random_table"]
