"""Landing zone, published tables and CSV snapshots."""
