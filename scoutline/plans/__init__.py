"""Compositions of the operators: the flagship plan, views over the test tables, the catalog."""
