"""The query catalogue."""
