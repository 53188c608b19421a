"""Structured Streaming jobs (incremental, exactly-once file ingestion)."""
