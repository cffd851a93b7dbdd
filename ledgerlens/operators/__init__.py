"""Reusable DataFrame operators (joins, lists, ranking, calendar, quality)."""
