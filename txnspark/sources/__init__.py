"""Batch sources and sinks."""
