"""Structured Streaming forms of capture, ingestion and publishing."""
