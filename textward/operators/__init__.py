"""Corpus, feature, evaluation, drift, selection and monitoring operators over DataFrames."""
