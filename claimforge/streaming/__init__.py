"""Incremental runs of the engine."""
