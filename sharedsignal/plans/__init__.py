"""Composite jobs, query registry and SQL oracles."""
