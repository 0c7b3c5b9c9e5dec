"""Sinks: CSV and table writers."""
