"""Readers: parquet/catalog tables, partner files as raw cells, settings, ingest log."""
