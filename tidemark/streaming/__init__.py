"""Structured Streaming: request topics and streaming ingest."""
