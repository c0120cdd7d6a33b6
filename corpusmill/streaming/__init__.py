"""Incremental variants of the batch operators, as Structured Streaming queries."""
