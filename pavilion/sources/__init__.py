"""Readers, writers and the adapter for star-schema tables."""
