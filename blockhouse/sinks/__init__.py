"""Writers and idempotent load modes (§2.2)."""
