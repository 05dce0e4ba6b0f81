"""Structured Streaming ingestion of product events."""
