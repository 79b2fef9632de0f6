"""Queries on the driver tables, and their SQL twins."""
