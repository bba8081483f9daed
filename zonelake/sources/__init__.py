"""Readers, writers, the catalog of zones and objects."""
