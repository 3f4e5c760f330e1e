"""Structured Streaming forms of the monitor, the embedding store and scoring."""
