"""Pipelines (rule sets) and the query catalogue."""
