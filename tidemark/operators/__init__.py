"""DataFrame operators: bars, features, labels, splits, models, monitoring."""
