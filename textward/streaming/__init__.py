"""Structured Streaming forms of the prediction operators."""
