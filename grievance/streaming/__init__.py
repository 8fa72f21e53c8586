"""Incremental landing-folder ingestion with Structured Streaming."""
from grievance.streaming.landing import current_raw, ingest_available, landing_stream, new_raw_since  # noqa: F401
