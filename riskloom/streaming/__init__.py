"""Structured Streaming: sources, decoding and scoring, sinks, live counts."""
