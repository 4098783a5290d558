"""Structured Streaming form of the daily feed."""
