"""DataFrame-to-DataFrame operators; as-of times and thresholds are always parameters."""
