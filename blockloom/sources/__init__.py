"""Readers of landed files, reference data and warehouse tables."""
