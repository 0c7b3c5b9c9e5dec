"""Streaming: incremental landing of daily order files."""
