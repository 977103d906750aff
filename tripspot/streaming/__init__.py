"""Structured Streaming jobs; the row logic is that of the batch operators."""
