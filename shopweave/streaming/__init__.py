"""Structured Streaming twins of the batch upserts."""
