"""Scorers trained and applied as Spark jobs."""
