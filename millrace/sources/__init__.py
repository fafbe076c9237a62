"""Readers of pages and tables, and sinks."""
