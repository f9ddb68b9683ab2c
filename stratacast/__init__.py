"""Hierarchical retail-demand analytics as plain Spark DataFrame jobs."""
