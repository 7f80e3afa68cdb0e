"""Structured Streaming jobs: landing and file ingestion."""
