"""Structured Streaming jobs: feeds, windowed aggregates, scoring, sinks."""
