"""Whole chains, dashboards and the registered queries."""
