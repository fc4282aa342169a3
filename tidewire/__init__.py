"""Incident and news analytics as plain Spark DataFrame, SQL and Structured Streaming work."""
