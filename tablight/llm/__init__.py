"""Operators of a training-data pipeline (packing, search, scoring, tokenising, filters)."""
