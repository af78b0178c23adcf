"""DataFrame-in, DataFrame-out operators over all series at once."""
