"""Structured Streaming jobs over a scoring log (file stream sources, parquet sinks)."""
