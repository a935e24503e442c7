"""Logical tables: where they come from, how they are stored, how results are published."""
