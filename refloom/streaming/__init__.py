"""Incremental re-runs and streams."""
