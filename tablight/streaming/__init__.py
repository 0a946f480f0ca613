"""Structured Streaming forms of the cleaning and scoring path."""
