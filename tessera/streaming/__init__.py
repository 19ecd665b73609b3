"""Structured Streaming jobs: log ingest and append ingest."""
