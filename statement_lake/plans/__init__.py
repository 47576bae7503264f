"""Stored tables, marts and the refresh job built from the operators."""
