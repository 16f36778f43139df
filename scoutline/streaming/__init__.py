"""Incremental forms of the discovery and contact jobs."""
