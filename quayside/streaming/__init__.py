"""File-arrival driven ingest with Structured Streaming."""
