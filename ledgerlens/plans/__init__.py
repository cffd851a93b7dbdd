"""Catalogue queries per business domain, each with a DuckDB oracle twin."""
