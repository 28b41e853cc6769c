"""Structured Streaming forms of the preparation and of the hourly cycle."""
