"""Whole jobs: chain models, event catalog, metric feeds, landing to table."""
