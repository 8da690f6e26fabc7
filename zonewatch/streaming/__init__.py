"""Structured Streaming pipelines and sinks."""
