"""Composite use cases and the registry of named queries."""
