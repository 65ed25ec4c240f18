"""Delivery of results in batches, and queries over unbounded input."""
