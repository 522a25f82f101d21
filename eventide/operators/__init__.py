"""Batch (and stream-compatible) operators: windows, distinct counts, top-N, joins, patterns, late data, state."""
