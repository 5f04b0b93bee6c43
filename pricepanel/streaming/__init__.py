"""Structured Streaming ingest of landed pages (``streaming.pages``)."""
