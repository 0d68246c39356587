"""Filters, extraction, merge, deduplication, lookups, scoring and search over DataFrames."""
