"""Canonical schema, readers and sinks."""
