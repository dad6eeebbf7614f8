"""Batch sinks: bronze, gold, catalog registration."""
