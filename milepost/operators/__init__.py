"""Relational operators: conforming, lookups, deduplication, merge, rollups, quality, reports."""
