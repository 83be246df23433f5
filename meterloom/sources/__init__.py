"""Readers, writers and the adapter from the driver tables."""
