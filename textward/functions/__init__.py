"""Column functions: text features, sampling keys, near-duplicate bands, test statistics."""
