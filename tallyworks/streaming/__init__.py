"""Structured Streaming forms of the incremental and stateful jobs."""
