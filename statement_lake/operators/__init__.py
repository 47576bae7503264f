"""Relational operators over typed statement data."""
