"""Incremental ingestion of daily drops with Structured Streaming."""
