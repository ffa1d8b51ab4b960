"""Monitoring-visit reporting over per-study tables, written as Spark jobs."""
