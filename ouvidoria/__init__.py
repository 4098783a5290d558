"""Complaint analytics on Spark: feeds, typed slices, classification, aggregates and dashboards.

Every operator is a ``DataFrame -> DataFrame`` function usable with ``DataFrame.transform``.
"""
