"""Corpus curation, text features, evaluation, drift and prediction monitoring on Spark."""

__version__ = "0.1.0"
