"""Operators over recordings, chunks and predictions."""
