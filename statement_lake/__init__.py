"""Brokerage statement analytics as Spark DataFrame jobs."""
