"""Composed jobs: ingest, dimensions, conformed table, marts, dashboard reads, refresh."""
