"""Operators over tables and property graphs."""
