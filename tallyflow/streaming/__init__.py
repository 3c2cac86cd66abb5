"""Structured Streaming forms of ingest, dedup, daily usage, merge and late-arrival routing."""
