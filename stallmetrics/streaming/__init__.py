"""Structured Streaming: change-log ingest, streams into tables, hourly sales."""
