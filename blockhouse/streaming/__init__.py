"""Structured Streaming forms of the hourly flows (§2.10)."""
