"""Incremental forms of the batch jobs on Structured Streaming."""
