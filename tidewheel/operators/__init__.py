"""Aggregations, joins, windows and domain operators over trips and stations."""
