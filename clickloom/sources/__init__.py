"""Readers, writers, table schemas and scratch folders."""
