"""Streaming jobs: sinks, metrics and the wiring of source to tables."""
