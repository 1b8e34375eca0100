"""Scans and landed-response sources (§2.1)."""
