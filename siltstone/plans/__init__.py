"""Whole jobs over document tables, and the registry of named queries."""
