"""Readers for landed API responses and stage tables, and their sinks."""
