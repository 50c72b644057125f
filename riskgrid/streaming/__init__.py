"""Incremental (Structured Streaming) form of the daily tally."""
