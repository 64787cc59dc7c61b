"""DataFrame operators: rules, profile, layers, reports, weights."""
