"""Continuous folder ingest."""
