"""Lookups, counts, joins and profiles over a social-review dataset, on Spark."""

from acquaint.tables import SocialTables

__all__ = ["SocialTables"]
