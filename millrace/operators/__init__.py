"""DataFrame operators: rules, normalisation, resolution, dedup, merge and metrics."""
