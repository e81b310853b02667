"""Structured Streaming: lineage of a growing query log."""
