"""Structured Streaming runs of the ingest stages."""
