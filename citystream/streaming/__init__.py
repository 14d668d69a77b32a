"""Structured Streaming: sources, sinks, stateful detectors and query wiring."""
