"""Composite jobs, bindings to the test tables and their SQL twins."""
