"""Structured Streaming queries over telemetry."""
