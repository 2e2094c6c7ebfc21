"""Snapshot exports to history, star schema and reports, as plain Spark jobs."""
