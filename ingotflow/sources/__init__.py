"""Scans: landed files, bronze tables, the message topic, named tables."""
