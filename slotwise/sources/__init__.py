"""Schemas, readers, writers and partitioned Parquet tables."""
