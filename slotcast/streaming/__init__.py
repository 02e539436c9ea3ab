"""Structured Streaming form of the slot aggregation."""
