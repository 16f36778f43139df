"""Column-to-column functions: text rules, numbers, times and JSON text."""
