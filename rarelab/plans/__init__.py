"""Composed studies and the registered query catalogue."""
