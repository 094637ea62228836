"""Readers, writers and graph import."""
