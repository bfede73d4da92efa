"""Incremental form of the ingest job."""
