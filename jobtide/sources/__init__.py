"""Readers and writers: landed JSON pages and Parquet tables."""
