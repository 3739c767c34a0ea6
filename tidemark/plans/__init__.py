"""Whole plans: batch pipelines and the query catalogue."""
