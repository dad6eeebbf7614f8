"""Structured Streaming sinks for the landing and bronze layers."""
