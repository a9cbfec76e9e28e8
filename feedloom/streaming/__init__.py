"""Repeated ingestion as a stream."""
