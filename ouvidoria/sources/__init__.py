"""Feeds, catalog tables and semi-structured pages."""
