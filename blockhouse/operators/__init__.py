"""DataFrame -> DataFrame operators (§2.3 .. §2.8)."""
