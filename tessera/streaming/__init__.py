"""Structured Streaming forms of the declared-table queries."""
