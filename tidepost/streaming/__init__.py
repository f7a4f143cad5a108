"""Structured Streaming: intake, scoring, alerts, windows, bands, comparison, deduplication."""
