"""Registered queries, their fixtures over the driver tables, and their SQL oracles."""
