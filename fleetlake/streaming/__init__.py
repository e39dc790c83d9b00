"""Incremental (Structured Streaming) form of the bronze CSV ingest."""
