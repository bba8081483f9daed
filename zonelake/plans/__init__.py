"""Whole jobs built from the operators: ingest, migration, marts, analysis."""
