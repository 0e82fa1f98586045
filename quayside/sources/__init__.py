"""Readers: file zones, warehouse tables, relational queries and configuration tables."""
